"""Distances on the sphere."""

from pyspark.sql import functions as F

from almanack.settings import EARTH_RADIUS_M


def haversine(latitude, longitude, point, radius=EARTH_RADIUS_M):
    """Metres from each row to a fixed ``(latitude, longitude)`` point."""
    lat0, lon0 = (F.radians(F.lit(float(v))) for v in point)
    lat, lon = F.radians(latitude), F.radians(longitude)
    chord = (
        F.pow(F.sin((lat - lat0) / 2), 2)
        + F.cos(lat0) * F.cos(lat) * F.pow(F.sin((lon - lon0) / 2), 2)
    )
    return 2 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))
