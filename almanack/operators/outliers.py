"""Abnormal periods: features, principal components, z-scores."""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from almanack.settings import OUTLIER_Z

#: scores below this share of the largest are rounding
NOISE = 1e-10


def standardised(features, keys=("series", "feature")):
    """Adds ``z`` with the population sd over the periods of each key; null where
    the feature does not vary."""
    w = Window.partitionBy(*keys)
    centred = F.col("value") - F.avg("value").over(w)
    return features.withColumn(
        "z", F.try_divide(centred, F.nullif(F.stddev_pop("value").over(w), F.lit(0.0)))
    )


def zscore_outliers(features, limit=OUTLIER_Z, keys=("series", "feature")):
    """``(series, period)`` with any |z| above ``limit``.

    Over n periods |z| cannot exceed the root of n - 1, so a limit of 3.2 needs 12.
    """
    return (
        standardised(features, keys)
        .groupBy("series", "period")
        .agg(F.max(F.abs("z")).alias("max_abs_z"))
        .where(F.col("max_abs_z") > limit)
    )


def merge_exclusions(derived, given):
    """Outlying and hand-picked ``(series, year)``, each once."""
    return derived.select("series", "year").unionByName(given.select("series", "year")).distinct()


def complete_features(features):
    """Leave out, per series, every feature that failed in some period."""
    failed = F.max(F.col("value").isNull()).over(Window.partitionBy("series", "feature"))
    return features.withColumn("_failed", failed).where("NOT _failed").drop("_failed")


def without_empty_periods(features):
    """Leave out periods without variation (spectral entropy 0)."""
    empty = F.max((F.col("feature") == "entropy") & (F.col("value") == 0)).over(
        Window.partitionBy("series", "period")
    )
    kept = features.withColumn("_empty", F.coalesce(empty, F.lit(False)))
    return kept.where("NOT _empty").drop("_empty")


def _scores(key, pdf):
    wide = pdf.pivot(index="period", columns="feature", values="z").sort_index().sort_index(axis=1)
    x = wide.fillna(0.0).to_numpy(dtype=float)
    left, singular, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    scores = left * singular
    return pd.DataFrame(
        {
            "series": key[0],
            "period": np.repeat(wide.index.to_numpy(), scores.shape[1]),
            "feature": [f"PC{i + 1}" for i in range(scores.shape[1])] * len(wide),
            "value": scores.ravel(),
        }
    )


def component_scores(features):
    """Scores on all principal components per series, long.

    A group is periods by features of one series (a few dozen squared), so each
    decomposition is small and series run in parallel.  Signs are arbitrary.
    """
    z = standardised(without_empty_periods(complete_features(features)))
    return (
        z.select("series", "period", "feature", "z")
        .groupBy("series")
        .applyInPandas(_scores, "series string, period string, feature string, value double")
    )


def pca_outliers(features, limit=OUTLIER_Z):
    """Periods that stand out on any component; rounding noise, which is small beside
    the largest score of the series, is not a component."""
    scores = component_scores(features)
    largest = F.max(F.abs("value")).over(Window.partitionBy("series"))
    scores = scores.withColumn("_largest", largest)
    noise = F.abs("value") <= F.col("_largest") * NOISE
    return zscore_outliers(scores.withColumn("value", F.when(noise, 0.0).otherwise(F.col("value"))), limit)
