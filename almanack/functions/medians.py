"""Exact medians that survive a hot group.

One way for every size: equal values are counted, values fall into cells that keep
their order, the cell holding the middle rank is found from the cell counts, and only
that cell's distinct values are ranked.  Counts combine on the map side, and a window
sees one row per cell or the distinct values of one cell, never the rows of a group.

Nulls are left out, NaN is larger than any number, and 0.0 and -0.0 are one value.
"""

from functools import reduce

from pyspark.sql import Window, functions as F

CELLS_PER_E_FOLD = 1000
LAST = 1 << 40


def _cell(value):
    """An integer that never decreases as the value grows (0.1 % wide cells)."""
    inner = F.floor(F.signum(value) * F.log1p(F.abs(value)) * CELLS_PER_E_FOLD)
    infinite = F.abs(value) == F.lit(float("inf"))
    return (
        F.when(F.isnan(value), F.lit(2 * LAST))
        .when(infinite, F.when(value > 0, F.lit(LAST)).otherwise(F.lit(-LAST)))
        .otherwise(inner)
        .cast("long")
    )


def _join_groups(left, right, keys, how):
    """Join on group keys where a null key is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def counted_median(df, keys, value, name):
    """``keys`` and the exact median; groups without a value have no row."""
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_cell", _cell(F.col("_v")))
    )
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = (
        counted.groupBy(*keys, "_cell")
        .agg(F.sum("_m").alias("_n"))
        .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_low", F.expr("(_total + 1) div 2"))
        .withColumn("_high", F.expr("_total div 2 + 1"))
        .where("_high > _before AND _low <= _before + _n")
        .drop("_n", "_total")
    )
    inside = (
        Window.partitionBy(*keys, "_cell")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        _join_groups(counted, cells, [*keys, "_cell"], "inner")
        .withColumn("_upto", F.col("_before") + F.sum("_m").over(inside))
        .where(
            "(_low <= _upto AND _low > _upto - _m) OR (_high <= _upto AND _high > _upto - _m)"
        )
        .groupBy(*keys)
        .agg(((F.min("_v") + F.max("_v")) / 2).alias(name))
    )


def agg_with_median(df, keys, value, name, *others):
    """``groupBy(keys)`` with an exact median of ``value`` and other aggregates."""
    groups = df.groupBy(*keys).agg(*others) if others else df.select(*keys).distinct()
    return _join_groups(groups, counted_median(df, keys, value, name), keys, "left")
