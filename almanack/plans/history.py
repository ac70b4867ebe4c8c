"""From raw counts and weather to one imputed long table."""

from pyspark.sql import functions as F

from almanack import settings as S
from almanack.operators.impute import impute_directions, split_impute
from almanack.operators.panel import dense_grid, melt_long
from almanack.operators.profile import prevalence_profile


def selected_counts(panel, min_years=S.MIN_YEARS, min_prevalence=S.MIN_PREVALENCE):
    """Rows of the series that pass the profile."""
    kept = prevalence_profile(panel, min_years, min_prevalence).select("series")
    return panel.join(kept, "series", "left_semi")


def modelled_counts(panel, unmodelled=tuple(S.UNMODELLED_SERIES)):
    """Without the series that only serve as features of others."""
    return panel.where(~F.col("series").isin(list(unmodelled)))


def imputed_history(counts, weather, start, end, cut, directions=(), circular=False,
                    n_years=S.NEAREST_YEARS):
    """Long ``(series, date, value, impute_method)`` of counts and weather on every day.

    ``weather`` is wide by date.  Its columns become series of the same long table,
    so the outer join of counts and weather on date is a union here.
    """
    columns = [c for c in weather.columns if c != "date"]
    long_weather = melt_long(weather, ["date"], columns, "series", "value")
    counts = dense_grid(counts.select("series", "date", "value"), start, end)
    grid = dense_grid(long_weather.select("series", "date", "value"), start, end)
    is_direction = F.col("series").isin(list(directions))
    filled = split_impute(counts, cut, S.SPAN_COUNTS, n_years).unionByName(
        split_impute(grid.where(~is_direction), cut, S.SPAN_WEATHER, n_years)
    )
    if not directions:
        return filled
    winds = grid.where(is_direction)
    if not circular:
        return filled.unionByName(split_impute(winds, cut, S.SPAN_WEATHER, n_years))
    return filled.unionByName(impute_directions(winds, S.SPAN_WEATHER, n_years, cut=cut))
