"""Compass directions in degrees."""

from pyspark.sql import functions as F


def direction_class(degrees):
    """16 compass classes, 1 = north; null (or NaN) stays null.

    A class is 22.5 degrees wide and north straddles zero, so everything from
    348.75 up and below 11.25 is class 1.
    """
    d = F.nanvl(degrees.cast("double"), F.lit(None).cast("double"))
    north = (d >= 348.75) | (d < 11.25)
    return (
        F.when(d.isNull(), F.lit(None))
        .when(north, F.lit(1))
        .otherwise(F.floor((d - 11.25) / 22.5) + 2)
        .cast("int")
    )


def valid_direction(degrees):
    """Readings over 360 are faults and become null."""
    return F.when(degrees <= 360, degrees)


def circular_mean(degrees):
    """Aggregate: mean direction in [0, 360).

    Null where the resultant has no direction (opposite readings cancel).
    Sums of sines and cosines combine on the map side like any average.
    """
    y = F.avg(F.sin(F.radians(degrees)))
    x = F.avg(F.cos(F.radians(degrees)))
    return F.when(
        F.hypot(y, x) > 1e-9, F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    )
