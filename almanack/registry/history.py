"""Imputation, windows along a series, seasons, peaks and the feature panel."""

from pyspark.sql import functions as F

from almanack.operators import impute as im, seasons, windows as wn
from almanack.operators.neighbours import with_other_counts, with_other_sum
from almanack.operators.panel import dense_grid, without_groups
from almanack.plans.features import exclusions_before, feature_panel
from almanack.plans.history import imputed_history, modelled_counts, selected_counts
from almanack.registry import fixtures as fx
from almanack.registry.base import register, with_
from almanack.registry.preparation import PEAKS_OF_OBS, THRESHOLD_OF_OBS
from almanack.settings import SEASON_SHARE
from almanack.sources import sinks
from almanack.sources.sinks import owned_by_session, staged, staging_path

# -- imputation -------------------------------------------------------------


def ewm_sql(source, span, out="ewm"):
    """Recursion over observed rows, folded over the last 200 of them."""
    a = 2 / (span + 1)
    return f"""{out}_numbered AS (
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS pos FROM {source}),
  {out}_folded AS (
    SELECT series, pos, list_reduce(h, lambda p, x: {{'k': x.k, 'y':
        (power(1 - CAST({a!r} AS DOUBLE), x.k - p.k) * p.y + CAST({a!r} AS DOUBLE) * x.y)
        / (power(1 - CAST({a!r} AS DOUBLE), x.k - p.k) + CAST({a!r} AS DOUBLE))}}).y AS y
    FROM (SELECT series, pos, list({{'k': pos, 'y': value}}) OVER (
            PARTITION BY series ORDER BY pos ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS h
          FROM {out}_numbered WHERE value IS NOT NULL)),
  {out} AS (
    SELECT n.series, n.date, n.value,
           last_value(y IGNORE NULLS) OVER (PARTITION BY n.series ORDER BY n.pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ewm
    FROM {out}_numbered n LEFT JOIN {out}_folded f ON f.series = n.series AND f.pos = n.pos)"""


def doy_sql(source, n, out, value="value"):
    return f"""{out}_donors AS (
    SELECT a.series, a.date, b.v,
           row_number() OVER (PARTITION BY a.series, a.date
             ORDER BY abs(year(b.date) - year(a.date)), year(b.date)) AS nearness
    FROM (SELECT series, date FROM {source} WHERE {value} IS NULL) a
    JOIN (SELECT series, date, {value} AS v FROM {source}) b
      ON a.series = b.series AND month(a.date) = month(b.date) AND day(a.date) = day(b.date)),
  {out} AS (
    SELECT s.*, m.doy_mean FROM {source} s LEFT JOIN (
      SELECT series, date, avg(v) AS doy_mean FROM {out}_donors WHERE nearness <= {n} GROUP BY 1, 2) m
    ON m.series = s.series AND m.date = s.date)"""


def doy_window_sql(source, n, out, value="value"):
    """As ``doy_sql``, from the rows of the same calendar day around each row."""
    return f"""{out} AS (
    SELECT *, CASE WHEN {value} IS NULL THEN list_avg(list_filter(
      list_transform(list_sort(near)[1:{n}], lambda x: x.v), lambda v: v IS NOT NULL)) END AS doy_mean
    FROM (SELECT *, list_transform(donors, lambda x: {{'far': abs(x.y - year(date)), 'y': x.y, 'v': x.v}}) AS near
      FROM (SELECT *, list({{'y': year(date), 'v': {value}}}) OVER (
              PARTITION BY series, month(date), day(date) ORDER BY date ROWS BETWEEN {n} PRECEDING AND {n} FOLLOWING) AS donors
            FROM {source})))"""


def impute_sql(source, span, n, out):
    """``out(series, date, value, impute_method)``"""
    return ",\n".join(
        [
            ewm_sql(source, span, f"{out}_e"),
            f"{out}_1 AS (SELECT *, coalesce(value, ewm) AS one FROM {out}_e)",
            doy_sql(f"{out}_1", n, f"{out}_2", "one"),
            f"""{out} AS (
    SELECT series, date,
      coalesce(one, doy_mean, first_value(coalesce(one, doy_mean) IGNORE NULLS) OVER (
        PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value,
      CASE WHEN value IS NOT NULL THEN 'observed' WHEN ewm IS NOT NULL THEN 'ewm'
           WHEN doy_mean IS NOT NULL THEN 'doy'
           WHEN first_value(coalesce(one, doy_mean) IGNORE NULLS) OVER (
        PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) IS NOT NULL
           THEN 'bfill' END AS impute_method
    FROM {out}_2)""",
        ]
    )


def _grid(spark, folder):
    return dense_grid(fx.obs_nation(spark, folder), fx.START, fx.END)


@register("dense_grid", with_(fx.OBS_NATION, fx.GRID) + "SELECT * FROM grid")
def dense_grid_query(spark, folder):
    return _grid(spark, folder)


@register("ewm_fill", with_(fx.OBS_NATION, fx.GRID, ewm_sql("grid", 7)) + """
  SELECT series, date, round(coalesce(value, ewm), 3) AS value FROM ewm""")
def ewm_fill(spark, folder):
    return im.with_ewm(_grid(spark, folder), 7).select(
        "series", "date", F.round(F.coalesce("value", "ewm"), 3).alias("value")
    )


@register("doy_fill", with_(fx.OBS_NATION, fx.GRID, doy_window_sql("grid", 3, "doy")) + """
  SELECT series, date, round(coalesce(value, doy_mean), 6) AS value FROM doy""")
def doy_fill(spark, folder):
    return im.with_nearest_years(_grid(spark, folder), 3).select(
        "series", "date", F.round(F.coalesce("value", "doy_mean"), 6).alias("value")
    )


@register("backfill", with_(fx.OBS_NATION, fx.GRID) + """
  SELECT series, date, first_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY date
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM grid""")
def backfill(spark, folder):
    return im.with_backfill(_grid(spark, folder)).select(
        "series", "date", F.col("backfill").alias("value")
    )


_ROUNDED = "SELECT series, date, round(value, 3) AS value, impute_method FROM "


@register("impute_markers", with_(fx.OBS_NATION, fx.GRID, impute_sql("grid", 7, 12, "filled")) + _ROUNDED + "filled")
def impute_markers(spark, folder):
    return im.impute(_grid(spark, folder), 7, 12).withColumn("value", F.round("value", 3))


@register("split_impute", with_(
    fx.OBS_NATION, fx.GRID, f"early AS (SELECT * FROM grid WHERE date < DATE '{fx.SPLIT}')",
    impute_sql("early", 7, 12, "a"), impute_sql("grid", 7, 12, "b")) + _ROUNDED + f"""a
  UNION ALL {_ROUNDED} b WHERE date >= DATE '{fx.SPLIT}'""")
def split_impute(spark, folder):
    return im.split_impute(_grid(spark, folder), fx.SPLIT, 7, 12).withColumn("value", F.round("value", 3))


_FEW, _MANY = ["0", "1", "2", "3", "4"], [str(n) for n in range(5, 25)]


@register("impute_groups", with_(
    fx.OBS_NATION, fx.GRID, "few AS (SELECT * FROM grid WHERE CAST(series AS INTEGER) < 5)",
    "many AS (SELECT * FROM grid WHERE CAST(series AS INTEGER) >= 5)",
    impute_sql("few", 5, 4, "a"), impute_sql("many", 7, 12, "b")) + _ROUNDED + f"a UNION ALL {_ROUNDED} b")
def impute_groups(spark, folder):
    groups = [(_FEW, 5, 4), (_MANY, 7, 12)]
    return im.impute_groups(_grid(spark, folder), groups).withColumn("value", F.round("value", 3))


def around_360(column):
    return F.round(column, 3) % 360


def directions_sql(source, span, n, out):
    """``out(series, date, value, impute_method)`` through sines and cosines."""
    return ",\n".join(
        [
            f"{out}_y AS (SELECT series, date, sin(radians(value)) AS value FROM {source})",
            f"{out}_x AS (SELECT series, date, cos(radians(value)) AS value FROM {source})",
            impute_sql(f"{out}_y", span, n, f"{out}_fy"),
            impute_sql(f"{out}_x", span, n, f"{out}_fx"),
            f"""{out} AS (
    SELECT y.series, y.date, y.impute_method,
           degrees(atan2(y.value, x.value)) + CASE WHEN atan2(y.value, x.value) < 0 THEN 360 ELSE 0 END AS value
    FROM {out}_fy y JOIN {out}_fx x ON x.series = y.series AND x.date = y.date)""",
        ]
    )


@register("impute_directions", with_(
    fx.OBS_NATION, fx.GRID, "degrees_grid AS (SELECT series, date, value % 360 AS value FROM grid)",
    directions_sql("degrees_grid", 5, 12, "turned"))
    + "SELECT series, date, round(value, 3) % 360 AS value, impute_method FROM turned")
def impute_directions(spark, folder):
    degrees = _grid(spark, folder).withColumn("value", F.col("value") % 360)
    return im.impute_directions(degrees, 5).withColumn("value", around_360("value"))


_WEATHER_COLUMNS = [
    "c_max_air_temp", "c_min_air_temp", "c_prcp_amt", "c_max_mean_wind_speed", "c_avg_airpress",
]


def _both_sides(early, whole):
    return f"""SELECT * FROM {early} UNION ALL SELECT * FROM {whole} WHERE date >= DATE '{fx.SPLIT}'"""


@register("imputed_history", with_(
    fx.OBS, """kept AS (SELECT series FROM obs WHERE value IS NOT NULL GROUP BY series
    HAVING count(*) / 365 > 0.1 AND sum(CASE WHEN value < 1 THEN 0 ELSE 1 END) / count(*) > 0.01)""",
    fx.WEATHER, fx.GRID.replace("(SELECT DISTINCT series FROM obs)", "kept"),
    "readings AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS series, date, {c} AS value FROM weather" for c in _WEATHER_COLUMNS) + ")",
    """numbers AS (SELECT s.series, d.date, r.value FROM (SELECT DISTINCT series FROM readings) s
    CROSS JOIN days d LEFT JOIN readings r ON r.series = s.series AND r.date = d.date),
  winds AS (SELECT 'c_mean_wind_dir' AS series, d.date, c_mean_wind_dir AS value
            FROM days d LEFT JOIN weather w ON w.date = d.date)""",
    *[f"{t}_early AS (SELECT * FROM {t} WHERE date < DATE '{fx.SPLIT}')" for t in ("grid", "numbers", "winds")],
    impute_sql("grid_early", 7, 12, "a"), impute_sql("grid", 7, 12, "b"),
    impute_sql("numbers_early", 5, 12, "c"), impute_sql("numbers", 5, 12, "d"),
    directions_sql("winds_early", 5, 12, "e"), directions_sql("winds", 5, 12, "f")) + f"""
  SELECT series, date, impute_method, round(value, 3) AS value
  FROM ({_both_sides('a', 'b')} UNION ALL {_both_sides('c', 'd')})
  UNION ALL SELECT series, date, impute_method, round(value, 3) % 360 FROM (
    SELECT series, date, value, impute_method FROM e
    UNION ALL SELECT series, date, value, impute_method FROM f WHERE date >= DATE '{fx.SPLIT}')""")
def imputed_history_query(spark, folder):
    """Profiled counts and weather, imputed without looking past the split."""
    counts = selected_counts(fx.obs(spark, folder), min_years=0.1)
    history = imputed_history(
        counts, fx.weather(spark, folder), fx.START, fx.END, fx.SPLIT, ["c_mean_wind_dir"], circular=True
    )
    is_wind = F.col("series") == "c_mean_wind_dir"
    return history.withColumn("value", F.when(is_wind, around_360("value")).otherwise(F.round("value", 3)))


# -- along a series ---------------------------------------------------------


@register("lags", with_(fx.OBS) + """
  SELECT series, date, value, lag(value, 1) OVER w AS value_lag1, lag(value, 2) OVER w AS value_lag2,
         lag(value, 3) OVER w AS value_lag3, lag(value, 4) OVER w AS value_lag4
  FROM obs WINDOW w AS (PARTITION BY series ORDER BY date)""")
def lags(spark, folder):
    return wn.with_lags(fx.obs(spark, folder), ["value"], 4)


@register("skip_first", with_(fx.OBS) + """
  SELECT series, date, value FROM (
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM obs) WHERE rn > 3""")
def skip_first(spark, folder):
    return wn.skip_first(fx.obs(spark, folder), 3)


@register("cluster_lag", with_(fx.OBS, fx.CLUSTERS) + """
  SELECT o.series, o.date, lag(coalesce(year_type_for_doy, 0)) OVER (
           PARTITION BY o.series ORDER BY o.date) AS year_type_for_doy_lag1
  FROM obs o LEFT JOIN clusters c
    ON c.series = o.series AND c.year = year(o.date) AND c.DoY = dayofyear(o.date)""")
def cluster_lag(spark, folder):
    panel = fx.obs(spark, folder)
    dated = panel.withColumns({"year": F.year("date"), "DoY": F.dayofyear("date")})
    return wn.with_cluster_lag(dated, fx.clusters(panel)).select("series", "date", "year_type_for_doy_lag1")


def run_sql(condition, partition, order, name, source):
    """Gaps and islands: rows since the last row without the event."""
    return f"""{name} AS (
    SELECT *, CAST(CASE WHEN happens THEN row_number() OVER (PARTITION BY {partition}, island ORDER BY {order})
         - CASE WHEN first_value(happens) OVER (PARTITION BY {partition}, island ORDER BY {order})
                THEN 0 ELSE 1 END ELSE 0 END % 1000 AS INTEGER) AS run
    FROM (SELECT *, sum(CASE WHEN happens THEN 0 ELSE 1 END) OVER (
            PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
          FROM (SELECT *, coalesce({condition}, false) AS happens FROM {source})))"""


@register("run_length", with_(
    fx.STATION_DAILY, run_sql("value >= 20", "site, variable", "date", "high", "station_daily"),
    run_sql("value >= 35", "site, variable", "date", "top", "station_daily")) + """
  SELECT h.site, h.variable, h.date, h.run AS run_high, t.run AS run_top
  FROM high h JOIN top t ON t.site = h.site AND t.variable = h.variable AND t.date = h.date""")
def run_length(spark, folder):
    readings = fx.station_daily(spark, folder)
    events = {"run_high": F.col("value") >= 20, "run_top": F.col("value") >= 35}
    runs = wn.with_run_lengths(readings, events, keys=("site", "variable"))
    return runs.select("site", "variable", "date", *events)


# -- seasons ----------------------------------------------------------------

_MARGIN = f"CAST({(1 - SEASON_SHARE) / 2!r} AS DOUBLE)"


def season_sql(source):
    return f"""season_flags AS (
    SELECT series, date, CAST(year(date) AS INTEGER) AS year, CAST(dayofyear(date) AS INTEGER) AS doy,
           CASE WHEN value IS NOT NULL THEN sum(value) OVER (PARTITION BY series, year(date) ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cum,
           sum(value) OVER (PARTITION BY series, year(date)) AS total FROM {source}),
  season_dates AS (
    SELECT series, year,
           min(doy) FILTER (WHERE total <> 0 AND cum >= total * {_MARGIN} AND cum < total * (1 - {_MARGIN})) AS season_start,
           min(doy) FILTER (WHERE total <> 0 AND cum >= total * (1 - {_MARGIN})) AS season_end
    FROM season_flags GROUP BY 1, 2),
  season_summary AS (
    SELECT series, CAST(round_even(avg(season_start), 0) AS DOUBLE) AS season_start_mean,
           CAST(round_even(avg(season_end), 0) AS DOUBLE) AS season_end_mean,
           CAST(round_even(stddev_samp(season_start), 2) AS DOUBLE) AS season_start_sd,
           CAST(round_even(stddev_samp(season_end), 2) AS DOUBLE) AS season_end_sd,
           min(season_start) AS season_start_earliest, max(season_end) AS season_end_latest,
           count(*) AS years_used
    FROM season_dates WHERE season_start IS NOT NULL OR season_end IS NOT NULL GROUP BY series)"""


@register("season_dates", with_(fx.OBS_NATION, season_sql("obs")) + """
  SELECT * FROM season_dates WHERE season_start IS NOT NULL OR season_end IS NOT NULL""")
def season_dates(spark, folder):
    return seasons.season_dates(fx.obs_nation(spark, folder))


@register("season_summary", with_(fx.OBS_NATION, season_sql("obs")) + "SELECT * FROM season_summary")
def season_summary(spark, folder):
    return seasons.season_summary(seasons.season_dates(fx.obs_nation(spark, folder)))


@register("season_trim", with_(fx.OBS_NATION, season_sql("obs")) + """
  SELECT o.series, o.date, o.value FROM obs o
  LEFT JOIN (SELECT * FROM season_summary WHERE series <> '7') s ON s.series = o.series
  WHERE s.series IS NULL OR dayofyear(o.date) BETWEEN season_start_earliest AND season_end_latest""")
def season_trim(spark, folder):
    panel = fx.obs_nation(spark, folder)
    known = seasons.season_summary(seasons.season_dates(panel)).where("series <> '7'")
    dated = panel.withColumn("DoY", F.dayofyear("date"))
    return seasons.trim_season(dated, known).select("series", "date", "value")


# -- other series -----------------------------------------------------------

OTHER_SUM = f"""others AS (
    SELECT o.series, o.date, o.value, coalesce((
        SELECT sum(x.value) FROM obs x
        WHERE x.date = o.date AND x.series <> o.series AND x.series <> '{fx.TOTAL}'), 0) AS sum_other_vars
    FROM obs o)"""


@register("other_series_sum", with_(fx.OBS, OTHER_SUM) + "SELECT * FROM others")
def other_series_sum(spark, folder):
    panel = fx.obs(spark, folder)
    return with_other_sum(panel, panel, fx.TOTAL)


@register("other_series_lags", with_(fx.OBS, OTHER_SUM) + """
  SELECT *, lag(sum_other_vars, 1) OVER w AS sum_other_vars_lag1, lag(sum_other_vars, 2) OVER w AS sum_other_vars_lag2
  FROM others WINDOW w AS (PARTITION BY series ORDER BY date)""")
def other_series_lags(spark, folder):
    panel = fx.obs(spark, folder)
    return wn.with_lags(with_other_sum(panel, panel, fx.TOTAL), ["sum_other_vars"], 2)


_NAMED = fx.SERIES
_COUNTS = ", ".join(
    f"CASE WHEN o.series <> '{n}' THEN (SELECT max(value) FROM obs x WHERE x.date = o.date AND x.series = '{n}') "
    f"END AS \"{n}\"" for n in _NAMED)


@register("other_series_counts", with_(fx.OBS, f"""joined AS (
    SELECT o.series, o.date, o.value, {_COUNTS} FROM obs o)""") + "SELECT *, " + ", ".join(
        f"lag(\"{n}\") OVER w AS \"{n}_lag1\"" for n in _NAMED)
    + " FROM joined WINDOW w AS (PARTITION BY series ORDER BY date)")
def other_series_counts(spark, folder):
    panel = fx.obs(spark, folder)
    return with_other_counts(panel, panel, _NAMED, 1)


@register("exclude_years", with_(fx.OBS, fx.EXCLUDED) + f"""
  SELECT o.series, o.date, o.value FROM obs o
  WHERE date < DATE '{fx.SPLIT}' AND NOT EXISTS (
    SELECT 1 FROM excluded e WHERE e.series = o.series AND e.year = year(o.date))""")
def exclude_years(spark, folder):
    panel = fx.obs(spark, folder)
    train = panel.where(F.col("date") < F.lit(fx.SPLIT)).withColumn("year", F.year("date"))
    return without_groups(train, fx.excluded_years(panel)).drop("year")


# -- the whole table --------------------------------------------------------

LAGGED = ["c_avg_airpress", "c_prcp_amt", "c_gdd"]
RUNS = {
    "run_temp_max_lag": ("c_max_air_temp", "temp_threshold"),
    "run_temp_min_lag": ("c_min_air_temp", "temp_threshold"),
    "run_precip_lag": ("c_prcp_amt", "precip_threshold"),
    "run_wind_speed_lag": ("c_max_mean_wind_speed", "max_wind_speed_threshold"),
}


def imputed_panel(spark, folder):
    """Imputed counts in whole numbers, written once because four branches read them."""
    grid = dense_grid(fx.obs(spark, folder), fx.START, fx.END)
    filled = im.split_impute(grid, fx.SPLIT, 7, 12)
    return staged(filled.select("series", "date", F.round("value", 0).alias("value")), "imputed")


def panel_of_features(spark, folder, exclusions=fx.excluded_years, **options):
    panel = imputed_panel(spark, folder)
    excluded = staged(exclusions(panel), "excluded")
    return feature_panel(
        panel, fx.weather(spark, folder), fx.thresholds(spark, folder), fx.clusters(panel),
        excluded, fx.SPLIT, lags=3, site_cuts=fx.SITE_CUTS,
        decade_cuts=fx.DECADE_CUTS, total_series=fx.TOTAL, lagged_weather=LAGGED, **options,
    )


def _lag_sql(columns, k):
    return ", ".join(
        f"lag({c}, {i}) OVER (PARTITION BY series ORDER BY date) AS {c}_lag{i}"
        for c in columns for i in range(1, k + 1)
    )


def _runs_sql():
    parts, source = [], "trimmed"
    for n, (c, limit) in RUNS.items():
        parts.append(run_sql(f"{c} >= {limit}", "series", "date", f"{n}_raw", source))
        parts.append(
            f"{n}_done AS (SELECT * EXCLUDE (run, island, happens), "
            f"lag(run) OVER (PARTITION BY series ORDER BY date) AS {n} FROM {n}_raw)"
        )
        source = f"{n}_done"
    return parts, source


_RUN_PARTS, _LAST_RUN = _runs_sql()
FEATURE_PANEL = with_(
    fx.OBS.replace("obs AS", "counted AS", 1),
    fx.GRID.replace("obs", "counted"),
    f"early AS (SELECT * FROM grid WHERE date < DATE '{fx.SPLIT}')",
    impute_sql("early", 7, 12, "a"), impute_sql("grid", 7, 12, "b"),
    f"""untouched AS (
    SELECT series, date, round(value, 0) AS value FROM a
    UNION ALL SELECT series, date, round(value, 0) FROM b WHERE date >= DATE '{fx.SPLIT}')""",
    fx.EXCLUDED.replace("FROM obs", "FROM untouched"),
    f"""cleaned AS (
    SELECT u.series, u.date, u.value AS untouched,
           CASE WHEN e.year IS NULL OR u.date >= DATE '{fx.SPLIT}' THEN u.value END AS value
    FROM untouched u LEFT JOIN excluded e ON e.series = u.series AND e.year = year(u.date)),
  clean_train AS (SELECT series, date, value FROM cleaned WHERE date < DATE '{fx.SPLIT}')""",
    season_sql("clean_train"),
    THRESHOLD_OF_OBS.replace("FROM obs", "FROM clean_train"),
    PEAKS_OF_OBS.replace("FROM obs", "FROM untouched"),
    fx.CLUSTERS.replace("FROM obs", "FROM untouched"), fx.WEATHER, fx.THRESHOLDS,
    f"""joined AS (
    SELECT c.series, c.date, c.value, p.peak, CAST(year(c.date) AS INTEGER) AS year,
           CAST(month(c.date) AS INTEGER) AS month, CAST(dayofyear(c.date) AS INTEGER) AS DoY,
           CAST(weekofyear(c.date) AS DOUBLE) AS week_1,
           CASE WHEN c.date < DATE '{fx.SITE_CUTS[0]}' THEN 0 WHEN c.date < DATE '{fx.SITE_CUTS[1]}' THEN 1
                WHEN c.date < DATE '{fx.SITE_CUTS[2]}' THEN 2 ELSE 3 END AS site,
           CASE WHEN c.date < DATE '{fx.DECADE_CUTS[0]}' THEN 0 WHEN c.date < DATE '{fx.DECADE_CUTS[1]}' THEN 1
                WHEN c.date < DATE '{fx.DECADE_CUTS[2]}' THEN 2
                WHEN c.date < DATE '{fx.DECADE_CUTS[3]}' THEN 3 ELSE 4 END AS decade_cat,
           w.* EXCLUDE (date),
           CASE WHEN c_mean_wind_dir >= 348.75 OR c_mean_wind_dir < 11.25 THEN 1
                ELSE CAST(floor((c_mean_wind_dir - 11.25) / 22.5) AS INTEGER) + 2 END AS c_mean_wind_dir_class,
           CASE WHEN c_max_air_temp IS NOT NULL THEN CAST(round_even(greatest(0.0,
             (c_max_air_temp + c_min_air_temp) / 2 - temp_threshold), 2) AS DOUBLE) END AS c_gdd,
           coalesce(k.year_type_for_doy, 0) AS code, h.* EXCLUDE (series)
    FROM cleaned c JOIN peaks p ON p.series = c.series AND p.date = c.date
    LEFT JOIN weather w ON w.date = c.date
    LEFT JOIN clusters k ON k.series = c.series AND k.year = year(c.date) AND k.DoY = dayofyear(c.date)
    LEFT JOIN thresholds h ON h.series = c.series),
  lagged AS (
    SELECT *, lag(code) OVER (PARTITION BY series ORDER BY date) AS year_type_for_doy_lag1,
           {_lag_sql(LAGGED, 3)} FROM joined),
  trimmed AS (
    SELECT l.* FROM lagged l LEFT JOIN season_summary s ON s.series = l.series
    WHERE s.series IS NULL OR l.DoY BETWEEN season_start_earliest AND season_end_latest)""",
    *_RUN_PARTS,
)
_WITHOUT = "value, code, temp_threshold, precip_threshold, max_wind_speed_threshold"


def last_steps(extra="", extra_lags=""):
    """From the run lengths to the finished table, with further columns if wanted."""
    return f""",
  others AS (
    SELECT r.* EXCLUDE ({_WITHOUT}), value AS outcome {extra}, coalesce((SELECT sum(x.value) FROM untouched x
             WHERE x.date = r.date AND x.series <> r.series AND x.series <> '{fx.TOTAL}'), 0) AS sum_other_vars
    FROM {_LAST_RUN} r WHERE value IS NOT NULL),
  complete AS (
    SELECT *, {_lag_sql(['sum_other_vars', 'outcome'], 3)} {extra_lags},
           row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM others)
  SELECT * EXCLUDE (rn) FROM complete WHERE rn > 3"""


_OTHER_COUNTS = "".join(
    f", CASE WHEN r.series <> '{n}' THEN (SELECT max(x.value) FROM untouched x "
    f"WHERE x.date = r.date AND x.series = '{n}') END AS \"{n}\"" for n in fx.SERIES)
_OTHER_LAGS = "".join(
    f", lag(\"{n}\", {i}) OVER (PARTITION BY series ORDER BY date) AS \"{n}_lag{i}\""
    for n in fx.SERIES for i in (1, 2, 3))


@register("feature_panel", FEATURE_PANEL + last_steps())
def feature_panel_query(spark, folder):
    return panel_of_features(spark, folder)


LIMIT = 1.9  # over the five years before the split no score exceeds 2


def _derived_sql():
    """Years that stand out before the split, by the features of shape and memory."""
    from almanack.registry import abnormal as ab

    yearly = "obs AS (SELECT series, CAST(year(date) AS VARCHAR) AS period, date, value FROM early_done)"
    features = f"features AS ({ab._long_sql('shape', ab.SHAPE)} UNION ALL {ab._long_sql('memory', ab.MEMORY)})"
    given = fx.EXCLUDED.replace("excluded AS", "given AS", 1).replace("FROM obs", "FROM untouched")
    return [
        f"early_done AS (SELECT * FROM untouched WHERE date < DATE '{fx.SPLIT}')", yearly,
        ab.POSITIONED, ab.SHAPE_SQL, ab.MEMORY_SQL, features, ab._Z, given,
        f"""excluded AS (SELECT series, year FROM given UNION
    SELECT series, CAST(period AS INTEGER) FROM scored GROUP BY series, period HAVING max(abs(z)) > {LIMIT})""",
    ]


def merged_years(panel):
    return exclusions_before(panel, fx.SPLIT, fx.excluded_years(panel), LIMIT)


@register("derived_exclusions", FEATURE_PANEL.split(",\ncleaned AS")[0].replace(
    fx.EXCLUDED.replace("FROM obs", "FROM untouched"), ",\n".join(_derived_sql())) + "\nSELECT series, year FROM excluded")
def derived_exclusions(spark, folder):
    """Years to leave out of training: outlying ones of the imputed panel and given ones."""
    return merged_years(imputed_panel(spark, folder))


@register("feature_panel_derived", FEATURE_PANEL.replace(
    fx.EXCLUDED.replace("FROM obs", "FROM untouched"), ",\n".join(_derived_sql())) + last_steps())
def feature_panel_derived(spark, folder):
    """The feature panel with the outlying years of each series found and left out."""
    return panel_of_features(spark, folder, exclusions=merged_years)


@register("modelled_counts", with_(fx.OBS) + f"SELECT * FROM obs WHERE series <> '{fx.SERIES[-1]}'")
def modelled_counts_query(spark, folder):
    return modelled_counts(fx.obs(spark, folder), [fx.SERIES[-1]])


@register("run_parameters", with_(fx.OBS) + f"""
  SELECT series, DATE '{fx.START}' AS date_start, DATE '{fx.SPLIT}' AS date_split,
         count(*) FILTER (WHERE date < DATE '{fx.SPLIT}') AS train_rows, count(*) AS rows FROM obs GROUP BY 1""")
def run_parameters(spark, folder):
    """Data and the parameters it was made with, stored together and read back: the split
    of the stored table comes from the stored parameters."""
    panel = fx.obs(spark, folder)
    place = staging_path(spark, "with-parameters")
    owned_by_session(spark, place)
    names = panel.select("series").distinct()
    sinks.write_with_parameters(panel, names, {"date_start": fx.START, "date_split": fx.SPLIT}, place)
    data, parameters = sinks.read_with_parameters(spark, place)
    counted = data.join(parameters, "series").groupBy("series", "date_start", "date_split")
    return counted.agg(F.count_if(F.col("date") < F.col("date_split")).alias("train_rows"), F.count(F.lit(1)).alias("rows"))


@register("feature_panel_with_counts", FEATURE_PANEL + last_steps(_OTHER_COUNTS, _OTHER_LAGS))
def feature_panel_with_counts(spark, folder):
    """As ``feature_panel`` with every other series' count and its lags."""
    return panel_of_features(spark, folder, other_counts=fx.SERIES)
