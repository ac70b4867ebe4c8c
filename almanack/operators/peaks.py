"""Peak days: a steep rise to a high count."""

from pyspark.sql import Window, functions as F

from almanack.operators.panel import by_date
from almanack.settings import PEAK_RISE, TOP_OF_QUANTILES


def peak_thresholds(panel, quantiles=TOP_OF_QUANTILES):
    """Smallest value of the top quantile per series, rounded half-even.

    Ranks are unique (ties broken by date) and cut at equal rank distances, which
    is not what ``ntile`` does.
    """
    ranked = Window.partitionBy("series").orderBy("value", "date")
    whole = Window.partitionBy("series")
    q = quantiles
    return (
        panel.where(F.col("value").isNotNull())
        .select(
            "series", "value",
            F.row_number().over(ranked).alias("_rank"),
            F.count(F.lit(1)).over(whole).alias("_n"),
        )
        .where(q * (F.col("_rank") - 1) > (q - 1) * (F.col("_n") - 1))
        .groupBy("series")
        .agg(F.bround(F.min("value"), 0).alias("threshold"))
    )


def flag_peaks(panel, thresholds, rise=PEAK_RISE, value="value"):
    """Adds ``peak`` (0/1): at least the threshold, at least ``rise`` of it gained
    since the previous row, and not the continuation of such a rise.

    Both sides are partitioned by series, so the join and the windows share the
    panel's shuffle.
    """
    w = by_date()
    gained = F.try_divide(F.col(value) - F.lag(value).over(w), F.col(value))
    return (
        panel.join(thresholds, "series", "left")
        .withColumn(
            "_raw",
            F.coalesce((gained >= rise) & (F.col(value) >= F.col("threshold")), F.lit(False)),
        )
        .withColumn("_again", F.coalesce(F.lag("_raw").over(w), F.lit(False)))
        .withColumn("peak", (F.col("_raw") & ~F.col("_again")).cast("int"))
        .drop("_raw", "_again", "threshold")
    )
