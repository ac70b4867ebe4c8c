"""Small numeric rules."""

from pyspark.sql import functions as F


def growing_degree_days(tmax, tmin, base):
    """Mean temperature above ``base``, floored at 0, two decimals half-even.

    Null when a temperature or the base is missing: ``greatest`` alone would
    skip the null and answer 0.
    """
    excess = (tmax + tmin) / 2 - base
    return F.when(
        excess.isNotNull(), F.bround(F.greatest(F.lit(0.0), excess), 2)
    )


def presence(value):
    """0 below one, 1 otherwise."""
    return F.when(value < 1, 0).otherwise(1)


def null_if(value, faulty):
    """``value`` unless ``faulty`` holds (an unknown test keeps the value)."""
    return F.when(~F.coalesce(faulty, F.lit(False)), value)


def finite(value):
    """NaN and both infinities become null."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return null_if(value, bad)


def number_or_null(text):
    """Text to double; ``NaN`` and anything unreadable become null."""
    return finite(F.expr("try_cast({} AS DOUBLE)".format(text)))
