"""Building and reshaping the daily panel.

``daily_panel`` is the way in: whatever the size of the raw table, it leaves one
row per ``(series, date)``.  A series therefore never exceeds the number of days
in the calendar (18,993 for 1970-2021), which bounds every window that later
partitions by series; no operator windows over raw rows.
"""

from pyspark.sql import Window, functions as F


def daily_panel(df, series, day, value, how=F.sum):
    """One row per (series, date); the aggregate combines on the map side."""
    return df.groupBy(series.alias("series"), day.alias("date")).agg(
        how(value).cast("double").alias("value")
    )


def by_date(*keys):
    """The window every per-series operator shares, so they share one shuffle."""
    return Window.partitionBy(*(keys or ("series",))).orderBy("date")


def running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def calendar(spark, start, end):
    """Dense list of days, ``date``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date")
    )


def dense_grid(panel, start, end, keys=("series",)):
    """Every day from ``start`` to ``end`` for every series; gaps get null values.

    A series without a row in the range has a grid of nulls: each series gets a
    scaffold row ahead of its first.  Each row emits the days up to the next row of
    its series, so nothing is joined, and operators that follow reuse the shuffle
    by series.  Two rows on one day are an error, as they are in a pivot.
    """
    start, end = F.lit(start).cast("date"), F.lit(end).cast("date")
    scaffold = panel.select(*keys).distinct().select(
        *keys, start.alias("date"), F.lit(None).cast("double").alias("value"), F.lit(0).alias("_real")
    )
    rows = panel.where(F.col("date").between(start, end)).select(
        *keys, "date", F.col("value").cast("double").alias("value"), F.lit(1).alias("_real")
    )
    upcoming = F.lead("date").over(Window.partitionBy(*keys).orderBy("date", "_real"))
    last = F.coalesce(F.date_sub(F.col("_next"), 1), end)
    twice = (F.col("_real") == 1) & (F.col("_next") == F.col("date"))
    return (
        rows.unionByName(scaffold)
        .withColumn("_next", upcoming)
        .withColumn(
            "_days",
            F.when(twice, F.raise_error(F.lit("two rows for one series and date")))
            .when(last >= F.col("date"), F.sequence(F.col("date"), last)),
        )
        .select(*keys, F.col("date").alias("_seen"), "value", F.explode("_days").alias("date"))
        .select(
            *keys, "date", F.when(F.col("date") == F.col("_seen"), F.col("value")).alias("value")
        )
    )


def missing_dates(panel, start, end, keys=("series",)):
    """Days without a value; a row whose value is null is also missing."""
    return (
        dense_grid(panel, start, end, keys).where(F.col("value").isNull()).select(*keys, "date")
    )


def pivot_wide(df, index, key, value, names):
    """Long to wide with known column names; a repeated cell is an error."""
    one = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("two values for one cell"))
    ).otherwise(F.first(value))
    return df.groupBy(*index).pivot(key, list(names)).agg(one)


def one_per_day(df):
    """The table itself, once it is certain to have one row per date.

    Used before a broadcast: the calendar then bounds its size.
    """
    twice = F.raise_error(F.lit("two rows for one date"))
    return df.groupBy("date").agg(
        *[
            F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.first(c)).alias(c)
            for c in df.columns if c != "date"
        ]
    )


def melt_long(df, ids, columns, key="variable", value="value"):
    return df.unpivot(list(ids), list(columns), key, value)


def null_counts(df, columns):
    """One row, one count per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def null_report(df, columns):
    """``(column, nulls)`` for the columns that have any."""
    return (
        melt_long(null_counts(df, columns), [], columns, "column", "nulls")
        .where(F.col("nulls") > 0)
    )


def inf_report(df, columns):
    """``(column, has_inf)`` per column."""
    row = df.agg(
        *[
            F.coalesce(F.bool_or(F.abs(F.col(c)) == F.lit(float("inf"))), F.lit(False)).alias(c)
            for c in columns
        ]
    )
    return melt_long(row, [], columns, "column", "has_inf")


def drop_null_columns(df, columns):
    """Drop those of ``columns`` that hold any null.  Runs one aggregate job."""
    nulls = null_counts(df, columns).first()
    return df.drop(*[c for c in columns if nulls[c]])


def drop_by_prefix(df, prefixes):
    """Drop the columns whose name starts with one of ``prefixes``."""
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def split_at(df, day, cut):
    """Rows before ``cut`` and rows from it on."""
    return df.where(F.col(day) < F.lit(cut)), df.where(F.col(day) >= F.lit(cut))


def without_groups(df, excluded, keys=("series", "year")):
    """Leave out whole (series, year) groups; the list is deduplicated first."""
    return df.join(excluded.select(*keys).distinct(), list(keys), "left_anti")
