"""Three-step imputation with a marker for every filled value.

Steps, each only for what is still missing: the exponentially weighted mean of
earlier values; the mean of the same calendar day over the nearest years; the
next value back.  Everything is windows on one shuffle by series.
"""

import math

from pyspark.sql import Window, functions as F

from almanack.operators.panel import by_date, running
from almanack.settings import NEAREST_YEARS


# decay is measured in e-folds, held as whole multiples of 1 / UNITS
UNITS = 10 ** 14
BLOCK = 200


def with_ewm(df, span, keys=("series",), value="value", name="ewm"):
    """Exponentially weighted mean of the values up to each row, by row position.

    Null rows repeat the last mean; nulls before the first value stay null.

    With smoothing factor a and a gap of g rows since the previous value, the mean
    is ``y = A y_prev + (1 - A) x`` where ``A = 1 / (1 + a (1 - a) ** -g)``.  Written
    out, each value counts with the decay passed since then, so y is a weighted
    running sum.  Weights would overflow over a long series; rows are therefore put
    into blocks of ``BLOCK`` e-folds of decay, weights restart in each block, and
    only the block before still matters (anything older weighs below e ** -200).
    That gives the whole recursion with windows: exact however sparse the values
    are, and linear in the rows.
    """
    if span <= 1:
        raise ValueError("span must be above 1")
    a = 2.0 / (span + 1)
    w = by_date(*keys)
    seen = F.col(value).isNotNull()
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_row", F.row_number().over(w))
    df = df.withColumn("_gap", F.col("_row") - F.max(F.when(seen, F.col("_row"))).over(earlier))
    growth = F.exp(-math.log(1 - a) * F.col("_gap")) * a
    step = F.least(F.log1p(growth), F.lit(2.0 * BLOCK))
    df = df.withColumn("_step", F.when(seen, F.coalesce((step * UNITS).cast("long"), F.lit(0))))
    # the sum is a decimal: a long would overflow after some 200,000 rows
    decay = F.sum(F.col("_step").cast("decimal(18,0)")).over(running(w)).cast("decimal(28,0)")
    df = df.withColumn("_decay", F.coalesce(decay, F.lit(0).cast("decimal(28,0)")))
    df = df.withColumn("_block", F.expr(f"CAST(_decay div {BLOCK * UNITS} AS LONG)"))
    df = df.withColumn("_inside", F.expr(f"CAST(_decay % {BLOCK * UNITS} AS DOUBLE)") / UNITS)
    share = F.when(F.col("_gap").isNull(), 1.0).otherwise(-F.expm1(-F.col("_step") / UNITS))
    block = Window.partitionBy(*keys, "_block").orderBy("date")
    # same order as by date, but one sort serves these and the windows per block
    whole = Window.partitionBy(*keys).orderBy("_block", "date")
    df = df.withColumn("_sum", F.sum(F.col(value) * share * F.exp("_inside")).over(running(block)))
    enters = F.when(F.lag("_block").over(whole) == F.col("_block") - 1, F.lag("_sum").over(whole))
    df = df.withColumn("_enters", F.coalesce(enters, F.lit(0.0)))
    carried = F.first("_enters").over(running(block)) * math.exp(-BLOCK)
    df = df.withColumn("_mean", F.when(seen, (F.col("_sum") + carried) * F.exp(-F.col("_inside"))))
    return df.withColumn(name, F.last("_mean", ignorenulls=True).over(running(whole))).drop(
        "_row", "_gap", "_step", "_decay", "_block", "_inside", "_sum", "_enters", "_mean"
    )


def with_nearest_years(df, n_years=NEAREST_YEARS, keys=("series",), value="value", name="doy_mean"):
    """Mean of the same month and day over the ``n_years`` nearest years.

    The row itself is one of them (distance 0); of two years equally far the
    earlier one comes first.  The nearest n lie within n rows either way, so the
    frame holds at most 2n + 1 values and no self join is needed.
    """
    day = Window.partitionBy(*keys, F.month("date"), F.dayofmonth("date")).orderBy("date")
    around = day.rowsBetween(-n_years, n_years)
    donor = F.struct(F.year("date").alias("y"), F.col(value).alias("v"))
    ordered = F.array_sort(
        F.transform(
            F.col("_donors"),
            lambda x: F.struct(F.abs(x["y"] - F.year("date")).alias("far"), x["y"].alias("y"), x["v"].alias("v")),
        )
    )
    kept = F.filter(F.slice(ordered, 1, n_years), lambda x: x["v"].isNotNull())
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x["v"])
    return (
        df.withColumn("_donors", F.collect_list(donor).over(around))
        .withColumn(
            name,
            F.when(F.col(value).isNull(), F.try_divide(total, F.size(kept).cast("double"))),
        )
        .drop("_donors")
    )


def with_backfill(df, keys=("series",), value="value", name="backfill"):
    """The next value; read forwards over the reversed order, which costs one
    pass where an unbounded-following frame would rescan the rest per row."""
    later = Window.partitionBy(*keys).orderBy(F.desc("date"))
    return df.withColumn(name, F.last(value, ignorenulls=True).over(running(later)))


def _filled(df, column, span, n_years, keys, method, cut=None):
    """Fill ``column`` in place and add the name of the step that did it.

    With a ``cut``, rows before it use only rows before it.  The weighted mean
    looks backwards anyway and rows from the cut on backfill from rows after them,
    so only the nearest years are looked up both ways.
    """
    early = F.lit(True) if cut is None else F.col("date") < F.lit(cut)
    df = with_ewm(df, span, keys, column, "_ewm").withColumn("_early", early)
    df = df.withColumn("_one", F.coalesce(column, "_ewm"))
    df = with_nearest_years(df, n_years, (*keys, "_early"), "_one", "_doy")
    if cut is not None:
        df = with_nearest_years(df, n_years, keys, "_one", "_doy_of_all")
        df = df.withColumn("_doy", F.when(F.col("_early"), F.col("_doy")).otherwise(F.col("_doy_of_all")))
    df = df.withColumn("_two", F.coalesce("_one", "_doy"))
    df = with_backfill(df, (*keys, "_early"), "_two", "_next")
    step = (
        F.when(F.col(column).isNotNull(), "observed")
        .when(F.col("_ewm").isNotNull(), "ewm")
        .when(F.col("_doy").isNotNull(), "doy")
        .when(F.col("_next").isNotNull(), "bfill")
    )
    df = df.withColumn(method, step).withColumn(column, F.coalesce("_two", "_next"))
    return df.drop("_ewm", "_one", "_doy", "_doy_of_all", "_two", "_next", "_early")


def impute(grid, span, n_years=NEAREST_YEARS, keys=("series",)):
    """Fill a dense grid; adds ``impute_method`` in observed, ewm, doy, bfill.

    A value nothing could fill stays null with a null method.
    """
    rows = grid.select(*keys, "date", "value")
    return _filled(rows, "value", span, n_years, keys, "impute_method")


def split_impute(grid, cut, span, n_years=NEAREST_YEARS, keys=("series",)):
    """Rows before ``cut`` see only rows before it; later rows see everything.

    Both in one pass over the grid.
    """
    rows = grid.select(*keys, "date", "value")
    return _filled(rows, "value", span, n_years, keys, "impute_method", cut)


def impute_groups(grid, groups, cut=None):
    """Impute groups of series with their own settings.

    ``groups`` is a list of ``(series names, span, n_years)``; the name filter
    reaches the scan, so each group reads only its own series.
    """
    parts = []
    for names, span, n_years in groups:
        part = grid.where(F.col("series").isin(list(names)))
        parts.append(impute(part, span, n_years) if cut is None else split_impute(part, cut, span, n_years))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def impute_directions(grid, span, n_years=NEAREST_YEARS, keys=("series",), cut=None):
    """Impute degrees through their sine and cosine, so 350 and 10 meet at 0.

    Both parts are columns of one frame and share its shuffle.  An observed
    direction comes back as it was, brought into [0, 360).
    """
    df = grid.select(
        *keys, "date",
        F.sin(F.radians("value")).alias("_y"), F.cos(F.radians("value")).alias("_x"),
    )
    df = _filled(df, "_y", span, n_years, keys, "impute_method", cut)
    df = _filled(df, "_x", span, n_years, keys, "_same", cut)
    turned = F.pmod(F.degrees(F.atan2("_y", "_x")), F.lit(360.0))
    return df.select(*keys, "date", turned.alias("value"), "impute_method")
