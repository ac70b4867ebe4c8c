"""Panels and station tables built from the given tables, in Spark and in SQL.

Values are whole numbers held as doubles, so sums do not depend on their order.
"""

from datetime import date

from pyspark.sql import functions as F

from almanack.functions.geo import haversine
from almanack.operators.panel import daily_panel
from almanack.settings import EARTH_RADIUS_M, SAMPLER_EARLIER, SAMPLER_LATER

START, END, SPLIT, SWITCH = date(1995, 1, 1), date(2001, 8, 1), date(2000, 1, 1), date(1998, 1, 1)
SITE_CUTS = (date(1996, 1, 1), date(1998, 1, 1), date(2000, 1, 1))
DECADE_CUTS = (date(1996, 1, 1), date(1997, 1, 1), date(1999, 1, 1), date(2001, 1, 1))
SERIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TOTAL = "3-MEDIUM"  # plays the series that already contains the others


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(column):
    return F.to_date(F.col(column))


# -- panels -----------------------------------------------------------------


def obs(spark, folder):
    orders = table(spark, folder, "orders")
    return daily_panel(orders, F.col("o_orderpriority"), day("o_orderdate"), F.floor("o_totalprice"))


OBS = """obs AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
         CAST(sum(floor(o_totalprice)) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""


def obs_nation(spark, folder):
    """25 series with many gaps."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return daily_panel(
        joined, F.col("c_nationkey").cast("string"), day("o_orderdate"), F.floor("o_totalprice")
    )


OBS_NATION = """obs AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS series, CAST(o_orderdate AS DATE) AS date,
         CAST(sum(floor(o_totalprice)) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

GRID = f"""days AS (
  SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS date),
grid AS (
  SELECT s.series, d.date, o.value
  FROM (SELECT DISTINCT series FROM obs) s CROSS JOIN days d
  LEFT JOIN obs o ON o.series = s.series AND o.date = d.date)"""


def small_obs(spark, folder):
    """As ``obs`` in units of ten thousand, with a month as the period."""
    orders = table(spark, folder, "orders")
    panel = daily_panel(
        orders, F.col("o_orderpriority"), day("o_orderdate"), F.floor(F.col("o_totalprice") / 10000)
    )
    return panel.withColumn("period", F.date_format("date", "yyyy-MM"))


SMALL_OBS = """obs AS (
  SELECT o_orderpriority AS series, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS period,
         CAST(o_orderdate AS DATE) AS date,
         CAST(sum(floor(o_totalprice / 10000)) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2, 3)"""


# -- weather ----------------------------------------------------------------


def temp(spark, folder):
    return (
        table(spark, folder, "lineitem").groupBy(day("l_shipdate").alias("date"))
        .agg(F.max("l_quantity").alias("tmax"), F.min("l_quantity").alias("tmin"))
    )


TEMP = """temp AS (
  SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS tmax, min(l_quantity) AS tmin
  FROM lineitem GROUP BY 1)"""


def weather(spark, folder):
    """One row per day under the names the feature plan expects."""
    return (
        table(spark, folder, "lineitem").groupBy(day("l_shipdate").alias("date"))
        .agg(
            F.max("l_quantity").alias("c_max_air_temp"),
            F.min("l_quantity").alias("c_min_air_temp"),
            F.count_if(F.col("l_returnflag") == "R").cast("double").alias("c_prcp_amt"),
            F.max("l_linenumber").cast("double").alias("c_max_mean_wind_speed"),
            F.sum("l_quantity").alias("c_avg_airpress"),
            (F.sum(F.col("l_quantity") * 7) % 400).alias("c_mean_wind_dir"),
        )
    )


WEATHER = """weather AS (
  SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS c_max_air_temp,
         min(l_quantity) AS c_min_air_temp,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS c_prcp_amt,
         CAST(max(l_linenumber) AS DOUBLE) AS c_max_mean_wind_speed,
         sum(l_quantity) AS c_avg_airpress,
         sum(l_quantity * 7) % 400 AS c_mean_wind_dir
  FROM lineitem GROUP BY 1)"""


def wind(spark, folder):
    """Directions with faults above 360 and gaps."""
    tenths = F.round(F.col("value") * 100)
    return table(spark, folder, "events").select(
        day("ts").alias("date"),
        F.col("user_id").alias("site"),
        (tenths % 400).alias("mean_wind_dir"),
        ((tenths * 3) % 400).alias("max_gust_dir"),
        tenths.alias("mean_wind_speed"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(tenths * 2)
        .alias("max_gust_speed"),
    )


WIND = """wind AS (
  SELECT CAST(ts AS DATE) AS date, user_id AS site, round(value * 100) % 400 AS mean_wind_dir,
         (round(value * 100) * 3) % 400 AS max_gust_dir, round(value * 100) AS mean_wind_speed,
         CASE WHEN event_type = 'error' THEN CAST('nan' AS DOUBLE)
              ELSE round(value * 100) * 2 END AS max_gust_speed
  FROM events)"""


# -- stations ---------------------------------------------------------------


def station_hourly(spark, folder):
    return table(spark, folder, "events").select(
        F.col("user_id").alias("site"), F.col("ts").alias("time"),
        F.col("event_type").alias("variable"), F.round(F.col("value") * 100).alias("value"),
    )


STATION_HOURLY = """station_hourly AS (
  SELECT user_id AS site, ts AS time, event_type AS variable, round(value * 100) AS value
  FROM events)"""


STATION_ROWS = 1 << 18


def station_tasks(spark, folder):
    """Tasks, two at least, for about ``STATION_ROWS`` readings each: sites grow with the
    table, so a task's groups do not."""
    return max(2, -(-table(spark, folder, "lineitem").count() // STATION_ROWS))


def station_daily(spark, folder):
    """One reading per (site, date, variable); 13 is a fault code."""
    readings = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("site"), day("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("variable"), "l_quantity",
    )
    dealt = readings.repartition(station_tasks(spark, folder), "site", "date")
    return dealt.groupBy("site", "date", "variable").agg(
        F.nullif(F.sum("l_quantity"), F.lit(13.0)).alias("value")
    )


STATION_DAILY = """station_daily AS (
  SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS date, l_returnflag AS variable,
         nullif(sum(l_quantity), 13) AS value
  FROM lineitem GROUP BY 1, 2, 3)"""


def flag_daily(spark, folder):
    flag = F.when(F.col("l_quantity") == 13, None).when(F.col("l_linestatus") == "O", 1).otherwise(0)
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("site"), day("l_shipdate").alias("date"), flag.alias("flag")
    )


FLAG_DAILY = """flag_daily AS (
  SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_quantity = 13 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS flag
  FROM lineitem)"""


def stations(spark, folder):
    lat, lon = 52 + (F.col("s_suppkey") % 100) / 100, F.lit(-2.0) + F.col("s_nationkey") / 25
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("site"), F.col("s_name").alias("observation_station"),
        lat.alias("latitude"), lon.alias("longitude"),
        haversine(lat, lon, SAMPLER_EARLIER).alias("dist_der"),
        haversine(lat, lon, SAMPLER_LATER).alias("dist_lei"),
    )


def _haversine_sql(point):
    return f"""2 * {EARTH_RADIUS_M} * asin(least(1.0, sqrt(
      power(sin((radians(52 + (s_suppkey % 100) / 100) - radians({point[0]})) / 2), 2)
      + cos(radians({point[0]})) * cos(radians(52 + (s_suppkey % 100) / 100))
        * power(sin((radians(-2.0 + s_nationkey / 25) - radians({point[1]})) / 2), 2))))"""


STATIONS = f"""stations AS (
  SELECT s_suppkey AS site, s_name AS observation_station,
         52 + (s_suppkey % 100) / 100 AS latitude, -2.0 + s_nationkey / 25 AS longitude,
         {_haversine_sql(SAMPLER_EARLIER)} AS dist_der, {_haversine_sql(SAMPLER_LATER)} AS dist_lei
  FROM supplier)"""


# -- lookups ----------------------------------------------------------------


def thresholds(spark, folder):
    """One row per series, from the priorities of the orders."""
    rank = F.substring("series", 1, 1).cast("double")
    priorities = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("series"))
    return priorities.distinct().select(
        "series",
        (rank + 24.25).alias("temp_threshold"),
        (rank + 3).alias("precip_threshold"),
        F.lit(7.0).alias("max_wind_speed_threshold"),
    )


THRESHOLDS = """thresholds AS (
  SELECT o_orderpriority AS series,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) + 24.25 AS temp_threshold,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) + 3 AS precip_threshold,
         CAST(7 AS DOUBLE) AS max_wind_speed_threshold
  FROM orders GROUP BY 1)"""


def clusters(panel):
    """Day-of-year codes for the days of spring and summer."""
    return panel.where(F.month("date").between(4, 9)).select(
        "series", F.year("date").alias("year"), F.dayofyear("date").alias("DoY"),
        (F.year("date") % 4).alias("year_type_for_doy"),
    )


CLUSTERS = """clusters AS (
  SELECT series, CAST(year(date) AS INTEGER) AS year, CAST(dayofyear(date) AS INTEGER) AS DoY,
         CAST(year(date) % 4 AS INTEGER) AS year_type_for_doy
  FROM obs WHERE month(date) BETWEEN 4 AND 9)"""


def excluded_years(panel):
    """Each series' year with the least total before the split, earliest of equals."""
    totals = panel.where(F.col("date") < F.lit(SPLIT)).groupBy("series", F.year("date").alias("year")).agg(
        F.sum("value").alias("total")
    )
    return totals.groupBy("series").agg(F.min_by("year", F.struct("total", "year")).alias("year"))


EXCLUDED = f"""excluded AS (
  SELECT series, year FROM (
    SELECT series, CAST(year(date) AS INTEGER) AS year,
           row_number() OVER (PARTITION BY series ORDER BY sum(value), year(date)) AS rn
    FROM obs WHERE date < DATE '{SPLIT}' GROUP BY series, year(date)) WHERE rn = 1)"""
