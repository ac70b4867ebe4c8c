"""Stations, directions and distances."""

from pyspark.sql import functions as F

from almanack.functions.angles import direction_class
from almanack.operators import stations as st
from almanack.operators.effects import class_effect_rank
from almanack.plans import weather as plan
from almanack.registry import fixtures as fx
from almanack.registry.base import register, with_
from almanack.settings import SAMPLER_EARLIER, SAMPLER_LATER
from almanack.sources.sinks import staged


def circular_sql(column, rounded=True):
    """Mean direction, rounded with the wrap at 360 removed afterwards."""
    mean = (
        f"CASE WHEN sqrt(power(avg(sin(radians({column}))), 2) + power(avg(cos(radians({column}))), 2)) > 1e-9 "
        f"THEN degrees(atan2(avg(sin(radians({column}))), avg(cos(radians({column}))))) END"
    )
    turned = f"({mean}) + CASE WHEN ({mean}) < 0 THEN 360 ELSE 0 END"
    return f"round({turned}, 6) % 360" if rounded else turned


def rounded_direction(column):
    return F.round(column, 6) % 360


@register("hourly_to_daily", with_(fx.STATION_HOURLY, """stats AS (
    SELECT site, CAST(time AS DATE) AS date, variable, max(value) AS max, min(value) AS min,
           avg(value) AS avg, median(value) AS med FROM station_hourly GROUP BY 1, 2, 3)""") + """
  SELECT site, date, 'c_' || stat || '_' || variable AS variable, value
  FROM stats UNPIVOT INCLUDE NULLS (value FOR stat IN (max, min, avg, med))""")
def hourly_to_daily(spark, folder):
    return st.hourly_to_daily(fx.station_hourly(spark, folder))


@register("circular_mean", with_(fx.WIND) + f"""
  SELECT date, site, {circular_sql('mean_wind_dir')} AS value FROM wind
  WHERE mean_wind_dir <= 360 GROUP BY date, site""")
def circular_mean(spark, folder):
    means = st.daily_direction(fx.wind(spark, folder), ["date", "site"], "mean_wind_dir")
    return means.withColumn("value", rounded_direction("value"))


@register("circular_mean_daily", with_(fx.WIND) + f"""
  SELECT date, {circular_sql('max_gust_dir')} AS value FROM wind
  WHERE max_gust_dir <= 360 GROUP BY date""")
def circular_mean_daily(spark, folder):
    means = st.daily_direction(fx.wind(spark, folder), ["date"], "max_gust_dir")
    return means.withColumn("value", rounded_direction("value"))


@register("station_mean", with_(fx.STATION_DAILY) + """
  SELECT variable, date, avg(value) AS value FROM station_daily GROUP BY 1, 2""")
def station_mean(spark, folder):
    return st.station_mean(fx.station_daily(spark, folder))


@register("station_median", with_(fx.STATION_DAILY) + """
  SELECT variable, date, median(value) AS value FROM station_daily GROUP BY 1, 2""")
def station_median(spark, folder):
    return st.station_median(fx.station_daily(spark, folder))


@register("any_flag", with_(fx.FLAG_DAILY) + """
  SELECT date, max(CASE WHEN flag > 0 THEN 1 WHEN flag IS NOT NULL THEN 0 END) AS flag
  FROM flag_daily GROUP BY date""")
def any_flag(spark, folder):
    return fx.flag_daily(spark, folder).groupBy("date").agg(st.any_flag(F.col("flag")).alias("flag"))


@register("strict_mean", with_(fx.STATION_DAILY) + """
  SELECT site, date, CASE WHEN count(value) = count(*) THEN avg(value) END AS value
  FROM station_daily WHERE variable IN ('A', 'N') GROUP BY 1, 2""")
def strict_mean(spark, folder):
    pair = fx.station_daily(spark, folder).where(F.col("variable").isin("A", "N"))
    return pair.groupBy("site", "date").agg(st.strict_mean(F.col("value")).alias("value"))


@register("station_counts", with_(fx.STATION_DAILY) + """
  SELECT variable, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         max(n) AS n_stations
  FROM (SELECT variable, date, count(*) AS n FROM station_daily GROUP BY 1, 2) GROUP BY 1, 2, 3""")
def station_counts(spark, folder):
    counts = st.station_counts(fx.station_daily(spark, folder))
    dated = counts.withColumns({"year": F.year("date"), "month": F.month("date")})
    return st.most_stations(dated, ["year", "month"])


@register("station_counts_yearly", with_(fx.STATION_DAILY) + """
  SELECT variable, CAST(year(date) AS INTEGER) AS year, max(n) AS n_stations
  FROM (SELECT variable, date, count(*) AS n FROM station_daily GROUP BY 1, 2) GROUP BY 1, 2""")
def station_counts_yearly(spark, folder):
    counts = st.station_counts(fx.station_daily(spark, folder))
    return st.most_stations(counts.withColumn("year", F.year("date")), ["year"])


@register("haversine", f"""
  SELECT s_suppkey AS site, round({fx._haversine_sql(SAMPLER_EARLIER)}, 4) AS dist_der,
         round({fx._haversine_sql(SAMPLER_LATER)}, 4) AS dist_lei FROM supplier""")
def haversine_query(spark, folder):
    placed = fx.stations(spark, folder)
    return placed.select(
        "site", F.round("dist_der", 4).alias("dist_der"), F.round("dist_lei", 4).alias("dist_lei")
    )


@register("nearest_station", with_(fx.STATION_DAILY, fx.STATIONS, f"""placed AS (
    SELECT d.*, CASE WHEN d.date < DATE '{fx.SWITCH}' THEN dist_der ELSE dist_lei END AS dist
    FROM station_daily d LEFT JOIN stations s ON s.site = d.site)""") + """
  SELECT site, date, variable, value, 'nearest' AS dataset FROM (
    SELECT *, rank() OVER (PARTITION BY variable, date ORDER BY dist NULLS LAST) AS r FROM placed)
  WHERE r = 1""")
def nearest_station(spark, folder):
    placed = fx.station_daily(spark, folder).join(fx.stations(spark, folder), "site", "left")
    distance = st.sampler_distance(F.col("date"), fx.SWITCH, F.col("dist_der"), F.col("dist_lei"))
    nearest = st.nearest_station(placed.withColumn("_d", distance), "_d")
    return nearest.select("site", "date", "variable", "value", F.lit("nearest").alias("dataset"))


@register("direction_class", with_(fx.WIND) + """
  SELECT date, site, mean_wind_dir, CASE WHEN mean_wind_dir >= 348.75 OR mean_wind_dir < 11.25 THEN 1
         ELSE CAST(floor((mean_wind_dir - 11.25) / 22.5) AS INTEGER) + 2 END AS class FROM wind""")
def direction_class_query(spark, folder):
    df = fx.wind(spark, folder)
    return df.select("date", "site", "mean_wind_dir", direction_class(F.col("mean_wind_dir")).alias("class"))


# -- five relations per sampler ---------------------------------------------


def _relations(spark, folder):
    supplier = fx.stations(spark, folder)
    stations = supplier.select(
        F.col("site").alias("src_id"), "observation_station",
        (F.round("dist_der", 0) / 1000).alias("distance_der"),
        (F.round("dist_lei", 0) / 1000).alias("distance_lei"),
    )
    items = fx.table(spark, folder, "lineitem")
    keys = [F.col("l_suppkey").alias("src_id"), fx.day("l_shipdate").alias("date")]

    def part(flag, **columns):
        return items.where(F.col("l_returnflag") == flag).groupBy(*keys).agg(
            *[c.alias(n) for n, c in columns.items()]
        )

    temperature = part("A", max_air_temp=F.max("l_quantity"), min_air_temp=F.min("l_quantity"))
    rain = part("N", prcp_amt=F.sum("l_quantity"))
    weather = part(
        "R",
        end_period=F.when(F.max("l_linenumber") % 3 == 0, "am").otherwise("pm"),
        thunder_day_flag=F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)),
    )
    radiation = items.where("l_linestatus = 'O'").groupBy(*keys).agg(
        F.sum("l_quantity").alias("glbl_irad_amt")
    )
    return stations, temperature, rain, weather, radiation


_RELATIONS = (fx.STATIONS, """st AS (
    SELECT site AS src_id, observation_station, round(dist_der, 0) / 1000 AS distance_der,
           round(dist_lei, 0) / 1000 AS distance_lei FROM stations),
  te AS (SELECT l_suppkey AS src_id, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS max_air_temp,
           min(l_quantity) AS min_air_temp FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
  ra AS (SELECT l_suppkey AS src_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS prcp_amt
         FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
  we AS (SELECT l_suppkey AS src_id, CAST(l_shipdate AS DATE) AS date,
           CASE WHEN max(l_linenumber) % 3 = 0 THEN 'am' ELSE 'pm' END AS end_period,
           max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS thunder_day_flag
         FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
  rd AS (SELECT l_suppkey AS src_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS glbl_irad_amt
         FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)""")


def _sampler_sql(distance, start, end, max_km, name):
    limit = "" if max_km is None else f"AND st.{distance} <= {max_km}"
    return f"""
  SELECT src_id, st.observation_station AS site, st.{distance} AS station_distance_km,
         CASE WHEN st.{distance} >= 30 THEN 'extra' WHEN st.{distance} < 30 THEN 'intra' END AS ring,
         te.date, max_air_temp, min_air_temp, prcp_amt, thunder_day_flag, glbl_irad_amt,
         CAST(year(te.date) AS INTEGER) AS year, CAST(month(te.date) AS INTEGER) AS month,
         CAST(day(te.date) AS INTEGER) AS day, '{name}' AS sampling_site
  FROM st FULL JOIN te USING (src_id)
  FULL JOIN ra ON te.date = ra.date AND te.src_id = ra.src_id
  FULL JOIN we ON te.date = we.date AND te.src_id = we.src_id
  FULL JOIN rd ON te.date = rd.date AND te.src_id = rd.src_id
  WHERE we.end_period = 'pm' {limit} AND te.date BETWEEN DATE '{start}' AND DATE '{end}'"""


_SAMPLERS = [
    ("distance_der", "1995-01-01", "1997-12-31", 60, "earlier"),
    ("distance_lei", "1998-01-01", "2001-12-31", None, "later"),
]
_STATION_ROWS = " UNION ALL ".join(_sampler_sql(*s) for s in _SAMPLERS)


def _station_rows(spark, folder):
    return st.samplers_join(*_relations(spark, folder), _SAMPLERS)


@register("station_full_join", with_(*_RELATIONS) + _STATION_ROWS)
def station_full_join(spark, folder):
    return _station_rows(spark, folder)


_COVERAGE = f"""db AS ({_STATION_ROWS}),
  coverage AS (
    SELECT year, nullif(count(DISTINCT CASE WHEN ring = 'intra' THEN site END), 0) AS intra,
           nullif(count(DISTINCT CASE WHEN ring = 'extra' THEN site END), 0) AS extra
    FROM db WHERE ring IS NOT NULL GROUP BY year),
  choice AS (SELECT *, CASE WHEN coalesce(intra, 0) < 2 THEN 'extra' ELSE 'intra' END AS ring FROM coverage)"""


@register("ring_coverage_choice", with_(*_RELATIONS, _COVERAGE) + "SELECT year, intra, extra, ring FROM choice")
def ring_coverage_choice(spark, folder):
    return st.ring_coverage(_station_rows(spark, folder))


_RULES = {
    "max_air_temp": "max", "min_air_temp": "min", "prcp_amt": "avg", "thunder_day_flag": "any",
    "glbl_irad_amt": "avg",
}
_CONSENSUS = """consensus AS (
    SELECT date, max(max_air_temp) AS c_max_air_temp, min(min_air_temp) AS c_min_air_temp,
           avg(prcp_amt) AS c_prcp_amt,
           max(CASE WHEN thunder_day_flag > 0 THEN 1 WHEN thunder_day_flag IS NOT NULL THEN 0 END)
             AS c_thunder_day_flag,
           avg(glbl_irad_amt) AS c_glbl_irad_amt
    FROM db JOIN choice USING (year, ring) GROUP BY date)"""


@register("consensus_daily", with_(*_RELATIONS, _COVERAGE, _CONSENSUS) + "SELECT * FROM consensus")
def consensus_daily(spark, folder):
    rows = staged(_station_rows(spark, folder), "station-rows")
    return st.consensus_daily(st.choose_ring(rows, st.ring_coverage(rows)), _RULES)


@register("consensus_weather", with_(*_RELATIONS, _COVERAGE, _CONSENSUS, fx.WIND, f"""
  m AS (SELECT date, {circular_sql('mean_wind_dir')} AS c_mean_wind_dir FROM wind
        WHERE mean_wind_dir <= 360 GROUP BY date),
  g AS (SELECT date, {circular_sql('max_gust_dir')} AS c_max_gust_dir FROM wind
        WHERE max_gust_dir <= 360 GROUP BY date),
  sp AS (SELECT date, avg(mean_wind_speed) AS c_mean_wind_speed,
                max(CASE WHEN isnan(max_gust_speed) THEN NULL ELSE max_gust_speed END) AS c_max_gust_speed
         FROM wind GROUP BY date)""") + """
  SELECT * FROM consensus FULL JOIN m USING (date) FULL JOIN g USING (date) FULL JOIN sp USING (date)""")
def consensus_weather(spark, folder):
    rows = staged(_station_rows(spark, folder), "station-rows")
    daily = plan.consensus_weather(rows, fx.wind(spark, folder), _RULES)
    return daily.withColumns(
        {c: rounded_direction(F.col(c)) for c in ("c_mean_wind_dir", "c_max_gust_dir")}
    )


# -- three datasets ---------------------------------------------------------


def _daily_station_table(spark, folder):
    """Readings of events as hourly, of lineitem as daily station values."""
    hourly = fx.station_hourly(spark, folder).withColumn(
        "variable", F.when(F.col("variable") == "click", "mean_wind_dir").otherwise(F.col("variable"))
    ).withColumn("value", F.when(F.col("variable") == "mean_wind_dir", F.col("value") % 400).otherwise(F.col("value")))
    names = F.create_map(
        *[F.lit(x) for x in ("A", "c_max_air_temp", "N", "c_min_air_temp", "R", "c_thunder_day_flag")]
    )
    daily = fx.station_daily(spark, folder).withColumn("variable", names[F.col("variable")]).withColumn(
        "value",
        F.when(F.col("variable") == "c_thunder_day_flag", F.greatest(F.col("value") - 60, F.lit(0.0)))
        .otherwise(F.col("value")),
    )
    return staged(plan.daily_station_table(
        hourly, daily, fx.stations(spark, folder), tasks=fx.station_tasks(spark, folder)), "station-days")


_DATASETS = (fx.STATION_HOURLY, fx.STATION_DAILY, fx.STATIONS, f"""hourly AS (
    SELECT site, CAST(time AS DATE) AS date,
           CASE WHEN variable = 'click' THEN 'mean_wind_dir' ELSE variable END AS variable,
           CASE WHEN variable = 'click' THEN value % 400 ELSE value END AS value FROM station_hourly),
  rolled AS (SELECT site, date, variable, max(value) AS max, min(value) AS min, avg(value) AS avg,
             median(value) AS med FROM hourly WHERE variable <> 'mean_wind_dir' GROUP BY 1, 2, 3),
  daily AS (SELECT site, date, CASE variable WHEN 'A' THEN 'c_max_air_temp' WHEN 'N' THEN 'c_min_air_temp'
              ELSE 'c_thunder_day_flag' END AS variable,
              CASE WHEN variable = 'R' THEN CASE WHEN value IS NULL THEN 0 ELSE greatest(value - 60, 0) END
              ELSE value END AS value FROM station_daily),
  base AS (SELECT site, date, variable, value FROM daily
    UNION ALL SELECT site, date, 'c_' || stat || '_' || variable, value
      FROM (UNPIVOT rolled ON max, min, avg, med INTO NAME stat VALUE value)
    UNION ALL SELECT site, date, 'c_mean_wind_dir', {circular_sql('value', False)} FROM hourly
      WHERE variable = 'mean_wind_dir' AND value <= 360 GROUP BY 1, 2
    UNION ALL SELECT site, date, 'c_avg_air_temp',
        CASE WHEN count(value) = count(*) THEN avg(value) END FROM daily
      WHERE variable IN ('c_max_air_temp', 'c_min_air_temp') GROUP BY 1, 2),
  placed AS (SELECT b.*, CASE WHEN b.date < DATE '{fx.SWITCH}' THEN dist_der ELSE dist_lei END AS dist
             FROM base b LEFT JOIN stations s ON s.site = b.site),
  shared AS (
    SELECT variable, date, CAST(max(CASE WHEN value > 0 THEN 1 WHEN value IS NOT NULL THEN 0 END) AS DOUBLE) AS value
      FROM base WHERE variable = 'c_thunder_day_flag' GROUP BY 1, 2
    UNION ALL SELECT variable, date, {circular_sql('value', False)} FROM base
      WHERE variable = 'c_mean_wind_dir' AND value <= 360 GROUP BY 1, 2),
  plain AS (SELECT * FROM base WHERE variable NOT IN ('c_thunder_day_flag', 'c_mean_wind_dir', 'c_max_gust_dir')),
  counts AS (SELECT variable, date, count(*) AS n_stations FROM base GROUP BY 1, 2)""")


@register("three_datasets", with_(*_DATASETS) + """
  SELECT dataset, a.variable, a.date,
         CASE WHEN a.variable = 'c_mean_wind_dir' THEN round(a.value, 5) % 360 ELSE round(a.value, 5) END AS value,
         CASE WHEN dataset <> 'nearest_station' THEN n_stations END AS n_stations FROM (
    SELECT 'station_mean' AS dataset, variable, date, avg(value) AS value FROM plain GROUP BY 2, 3
    UNION ALL SELECT 'station_median', variable, date, median(value) FROM base
      WHERE variable <> 'c_mean_wind_dir' GROUP BY 2, 3
    UNION ALL SELECT 'station_mean', variable, date, value FROM shared
    UNION ALL SELECT 'station_median', variable, date, value FROM shared WHERE variable = 'c_mean_wind_dir'
    UNION ALL SELECT 'nearest_station', variable, date, value FROM (
      SELECT *, rank() OVER (PARTITION BY variable, date ORDER BY dist NULLS LAST) AS r FROM placed)
      WHERE r = 1) a
  LEFT JOIN counts c ON c.variable = a.variable AND c.date = a.date""")
def three_datasets(spark, folder):
    sets = plan.three_datasets(_daily_station_table(spark, folder), fx.SWITCH)
    is_wind = F.col("variable") == "c_mean_wind_dir"
    value = F.when(is_wind, F.round("value", 5) % 360).otherwise(F.round("value", 5))
    return sets.withColumn("value", value)


@register("wide_dataset", with_(*_DATASETS) + """
  SELECT date, round(avg(CASE WHEN variable = 'c_avg_air_temp' THEN value END), 5) AS c_avg_air_temp,
         round(avg(CASE WHEN variable = 'c_max_air_temp' THEN value END), 5) AS c_max_air_temp
  FROM plain WHERE variable IN ('c_avg_air_temp', 'c_max_air_temp') GROUP BY date""")
def wide_dataset(spark, folder):
    sets = plan.three_datasets(_daily_station_table(spark, folder), fx.SWITCH)
    names = ["c_avg_air_temp", "c_max_air_temp"]
    wide = plan.wide_dataset(sets.where(F.col("variable").isin(names)), "station_mean", names)
    return wide.withColumns({n: F.round(n, 5) for n in names})


# -- effects ----------------------------------------------------------------


def _classed(spark, folder):
    orders, items = fx.table(spark, folder, "orders"), fx.table(spark, folder, "lineitem")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    degrees = (F.col("l_partkey") * 7 % 360).cast("double")
    return joined.select(
        F.col("l_linenumber").alias("site"), F.col("o_orderpriority").alias("series"),
        direction_class(degrees).alias("class"), F.col("l_quantity").alias("value"),
    )


@register("class_effect_rank", with_("""classed AS (
    SELECT l_linenumber AS site, o_orderpriority AS series, CAST(l_partkey * 7 % 360 AS DOUBLE) AS d,
           l_quantity AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  coded AS (SELECT site, series, value, CASE WHEN d >= 348.75 OR d < 11.25 THEN 1
              ELSE CAST(floor((d - 11.25) / 22.5) AS INTEGER) + 2 END AS class FROM classed),
  means AS (SELECT site, series, class, avg(value) AS m FROM coded GROUP BY 1, 2, 3),
  based AS (SELECT *, min(class) OVER (PARTITION BY site, series) AS base FROM means),
  effects AS (SELECT b.site, b.series, b.class,
      CASE WHEN b.class = b.base THEN b.m ELSE b.m - o.m END AS effect
    FROM based b JOIN based o ON o.site = b.site AND o.series = b.series AND o.class = b.base)""") + """
  SELECT site, series, class, round(effect, 9) AS effect,
         (SELECT count(*) FROM effects y WHERE y.site = x.site AND y.series = x.series AND y.effect > x.effect)
         + ((SELECT count(*) FROM effects y WHERE y.site = x.site AND y.series = x.series
             AND y.effect = x.effect) + 1) / 2 AS cor_rank
  FROM effects x""")
def class_effect_rank_query(spark, folder):
    ranked = class_effect_rank(_classed(spark, folder))
    return ranked.withColumn("effect", F.round("effect", 9))
