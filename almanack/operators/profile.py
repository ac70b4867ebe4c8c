"""Which series are worth keeping."""

from pyspark.sql import functions as F

from almanack.functions.numeric import presence
from almanack.settings import MIN_PREVALENCE, MIN_YEARS, UNKNOWN_SERIES


def prevalence_profile(panel, min_years=MIN_YEARS, min_prevalence=MIN_PREVALENCE,
                       unknown=UNKNOWN_SERIES):
    """``(series, prevalence, num_years)`` of series counted long and often enough.

    A day counts once it has a value; it is a present day from one upwards.
    """
    profile = (
        panel.where(F.col("value").isNotNull())
        .groupBy("series")
        .agg(F.sum(presence(F.col("value"))).alias("present"), F.count("value").alias("counted"))
        .select(
            "series",
            (F.col("present") / F.col("counted")).alias("prevalence"),
            (F.col("counted") / 365).alias("num_years"),
        )
    )
    keep = (
        (F.col("num_years") > min_years)
        & (F.col("prevalence") > min_prevalence)
        & (F.col("series") != unknown)
    )
    return (
        profile.where(keep)
        .orderBy(F.desc("num_years"), F.desc("prevalence"))
        .select(
            "series",
            F.bround("prevalence", 2).alias("prevalence"),
            F.bround("num_years", 2).alias("num_years"),
        )
    )
