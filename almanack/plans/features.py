"""The modelling table: one row per (series, date) inside the season."""

from pyspark.sql import functions as F

from almanack import settings as S
from almanack.functions.angles import direction_class
from almanack.functions.dates import bucket_by_dates, with_calendar_parts
from almanack.functions.numeric import growing_degree_days
from almanack.operators.neighbours import with_other_counts, with_other_sum
from almanack.operators.outliers import merge_exclusions, zscore_outliers
from almanack.operators.panel import one_per_day
from almanack.operators.peaks import flag_peaks, peak_thresholds
from almanack.operators.seasons import season_dates, season_summary, trim_season
from almanack.operators.tsfeatures import native_features, selected_features
from almanack.operators.windows import skip_first, with_code_lag, with_lags, with_run_lengths


def exclusions_before(panel, cut, given, limit=S.OUTLIER_Z, names=None):
    """``(series, year)`` to leave out of training: years before ``cut`` any of whose
    features stands out among the years of its series, and the ``given`` ones.

    Later values are not looked at.  ``names``: the features to score, all of shape and
    memory by default.
    """
    years = panel.where(F.col("date") < F.lit(cut)).withColumn("period", F.year("date").cast("string"))
    features = native_features(years) if names is None else selected_features(years, names)
    found = zscore_outliers(features, limit)
    return merge_exclusions(found.select("series", F.col("period").cast("int").alias("year")), given)


def feature_panel(panel, weather, thresholds, clusters, excluded, cut, lags=3,
                  site_cuts=S.SITE_CUTS, decade_cuts=S.DECADE_CUTS, share=S.SEASON_SHARE,
                  total_series=S.TOTAL_SERIES, lagged_weather=S.LAGGED_WEATHER,
                  run_rules=S.RUN_RULES, other_counts=()):
    """Assemble the features of every series in one plan.

    ``panel`` is the imputed dense ``(series, date, value)``, ``weather`` one row per day,
    ``thresholds`` one row per series.  It is read by four branches (thresholds,
    seasons, day totals, the rows themselves) and ``excluded`` by three, so pass
    tables, not long plans.

    Excluded (series, year) groups lose their values before ``cut`` but keep their
    rows, so lags and runs still step through them.  Peak thresholds and season
    dates come from what is left before ``cut``; peaks and the other series' sums
    from the untouched values.  Weather lags are taken before the season is
    trimmed, run lengths and the other series' lags after it, on the rows that
    remain.  The lookups by year and day come first, while rows are narrow; after
    the join by series every window reuses its partitioning.
    """
    panel = panel.select("series", "date", "value")
    dropped = excluded.select("series", "year").distinct().withColumn("_excluded", F.lit(True))
    untouched = panel.withColumnRenamed("value", "_untouched").withColumns(
        {"year": F.year("date"), "DoY": F.dayofyear("date")}
    )
    usable = F.col("_excluded").isNull() | (F.col("date") >= F.lit(cut))
    rows = (
        untouched.join(dropped, ["series", "year"], "left")
        .withColumn("value", F.when(usable, F.col("_untouched")))
        .drop("_excluded")
    )
    clean_train = rows.where(F.col("date") < F.lit(cut)).select("series", "date", "value")
    season = season_summary(season_dates(clean_train, share))

    df = rows.join(clusters, ["series", "year", "DoY"], "left")
    df = df.join(thresholds, "series", "left")
    df = flag_peaks(df, peak_thresholds(clean_train), value="_untouched").drop("_untouched")
    df = with_code_lag(df)
    df = with_calendar_parts(df).join(one_per_day(weather), "date", "left")
    directions = [c for c in S.WEATHER_DIRECTIONS if c in weather.columns]
    df = df.withColumns(
        {
            "site": bucket_by_dates(F.col("date"), site_cuts),
            "decade_cat": bucket_by_dates(F.col("date"), decade_cuts),
            "c_gdd": growing_degree_days(
                F.col("c_max_air_temp"), F.col("c_min_air_temp"), F.col("temp_threshold")
            ),
            **{f"{c}_class": direction_class(F.col(c)) for c in directions},
        }
    )
    df = with_lags(df, [c for c in lagged_weather if c in df.columns], lags)
    df = trim_season(df, season)
    df = with_run_lengths(
        df, {n: F.col(c) >= F.col(limit) for n, (c, limit) in run_rules.items()}, lagged=True
    )
    df = df.where(F.col("value").isNotNull()).drop(*[c for c in thresholds.columns if c != "series"])
    df = with_other_sum(df, panel, total_series, absent=False)
    if other_counts:
        df = with_other_counts(df, panel, other_counts, lags)
    df = df.withColumnRenamed("value", "outcome")
    df = with_lags(df, ["sum_other_vars", "outcome"], lags)
    return skip_first(df, lags)
