"""Season bounds from each year's share of its total."""

from pyspark.sql import Window, functions as F

from almanack.operators.panel import running
from almanack.settings import SEASON_SHARE


def season_flags(panel, share=SEASON_SHARE):
    """Adds ``season``: 0 before, 1 within and 2 after the middle ``share`` of the
    year's total; null when the year has no total or the day no value."""
    margin = (1 - share) / 2
    year = Window.partitionBy("series", "year")
    upto = running(year.orderBy("date"))
    so_far = F.when(F.col("value").isNotNull(), F.sum("value").over(upto))
    return (
        panel.withColumn("year", F.year("date"))
        .withColumns({"_sum": so_far, "_total": F.sum("value").over(year)})
        .withColumn(
            "season",
            F.when(F.coalesce(F.col("_total"), F.lit(0.0)) == 0, None)
            .when(F.col("_sum") >= F.col("_total") * (1 - margin), 2)
            .when(F.col("_sum") >= F.col("_total") * margin, 1)
            .when(F.col("_sum").isNotNull(), 0),
        )
        .drop("_sum", "_total")
    )


def season_dates(panel, share=SEASON_SHARE):
    """First day of year within and first after the season, per (series, year)."""

    def first_day(flag):
        return F.min(F.when(F.col("season") == flag, F.dayofyear("date")))

    return (
        season_flags(panel, share)
        .groupBy("series", "year")
        .agg(first_day(1).alias("season_start"), first_day(2).alias("season_end"))
        .where("season_start IS NOT NULL OR season_end IS NOT NULL")
    )


def season_summary(dates):
    """One row per series over its years."""
    return dates.groupBy("series").agg(
        F.bround(F.avg("season_start"), 0).alias("season_start_mean"),
        F.bround(F.avg("season_end"), 0).alias("season_end_mean"),
        F.bround(F.stddev_samp("season_start"), 2).alias("season_start_sd"),
        F.bround(F.stddev_samp("season_end"), 2).alias("season_end_sd"),
        F.min("season_start").alias("season_start_earliest"),
        F.max("season_end").alias("season_end_latest"),
        F.count(F.lit(1)).alias("years_used"),
    )


def trim_season(df, summary, doy="DoY"):
    """Days inside the earliest start and latest end; a series without season
    dates is left whole."""
    bounds = summary.select(
        "series", F.lit(True).alias("_known"), "season_start_earliest", "season_end_latest"
    )
    inside = F.col(doy).between(F.col("season_start_earliest"), F.col("season_end_latest"))
    return (
        df.join(bounds, "series", "left")
        .where(F.col("_known").isNull() | inside)
        .drop("_known", "season_start_earliest", "season_end_latest")
    )
