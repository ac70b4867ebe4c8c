"""Ranking the levels of a category by their effect on a value."""

from pyspark.sql import Window, functions as F


def class_effect_rank(df, keys=("site", "series"), category="class", base=1):
    """Rank of each class's least-squares coefficient, largest first, ties averaged.

    With one categorical regressor the fit is the group means: the intercept is
    the mean of the base class and every other coefficient its difference from
    it.  Where the base class is absent the lowest class seen takes its place.
    """
    whole = Window.partitionBy(*keys)
    means = (
        df.where(F.col("value").isNotNull() & F.col(category).isNotNull())
        .groupBy(*keys, category)
        .agg(F.avg("value").alias("_mean"))
        .withColumn(
            "_base",
            F.coalesce(
                F.max(F.when(F.col(category) == base, F.col(category))).over(whole),
                F.min(category).over(whole),
            ),
        )
        .withColumn("_base_mean", F.max(F.when(F.col(category) == F.col("_base"), F.col("_mean"))).over(whole))
        .withColumn(
            "effect",
            F.when(F.col(category) == F.col("_base"), F.col("_mean")).otherwise(
                F.col("_mean") - F.col("_base_mean")
            ),
        )
    )
    best_first = whole.orderBy(F.desc("effect"))
    tied = F.count(F.lit(1)).over(Window.partitionBy(*keys, "effect"))
    return means.select(
        *keys, category, "effect",
        (F.rank().over(best_first) + (tied - 1) / 2).alias("cor_rank"),
    )
