"""What the other series did on the same day."""

from pyspark.sql import Window, functions as F

from almanack.operators.panel import pivot_wide
from almanack.operators.windows import with_lags


def other_sums(panel, total_series=None, keys=None):
    """``(series, date, sum_other_vars)`` for the cells of ``panel``, and of ``keys``
    where given.

    Sums the other series themselves, before and after the own one in their order:
    a total less the own value would lose small values beside large ones, and one
    infinite value would spoil all.  A window holds one row per series.
    """
    value = F.col("value")
    if total_series is not None:  # a total has others, but is none
        value = F.when(~F.col("series").eqNullSafe(F.lit(total_series)), value)
    cells = panel.select("series", "date", value.alias("value"))
    if keys is not None:
        nothing = F.lit(None).cast("double").alias("value")
        cells = cells.unionByName(keys.select("series", "date", nothing))
    cells = cells.groupBy("series", "date").agg(F.sum("value").alias("value"))
    earlier = (Window.unboundedPreceding, -1)
    up = Window.partitionBy("date").orderBy("series").rowsBetween(*earlier)
    down = Window.partitionBy("date").orderBy(F.desc("series")).rowsBetween(*earlier)
    parts = [F.coalesce(F.sum("value").over(w), F.lit(0.0)) for w in (up, down)]
    return cells.select("series", "date", (parts[0] + parts[1]).alias("sum_other_vars"))


def with_other_sum(df, panel, total_series=None, absent=True):
    """Adds ``sum_other_vars``, nulls skipped; an aggregate total is no other series.

    ``absent=False`` promises that ``panel`` has a row for every row of ``df``, as a
    dense grid has; ``df`` is then planned once.
    """
    sums = other_sums(panel, total_series, df if absent else None)
    return df.join(sums, ["series", "date"], "left")


def with_other_counts(df, panel, names, lags=0):
    """Adds each named series' count of the day as a column, and its lags.

    The wide table has one row per calendar day and a known set of columns; a
    series does not see its own column.
    """
    wide = pivot_wide(panel.where(F.col("series").isin(list(names))), ["date"], "series", "value", names)
    joined = df.join(wide, "date", "left")
    joined = joined.withColumns(
        {n: F.when(F.col("series") != n, F.col(n)) for n in names}
    )
    return with_lags(joined, names, lags) if lags else joined
