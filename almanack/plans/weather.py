"""From station readings to one weather row per day."""

from pyspark.sql import functions as F

from almanack import settings as S
from almanack.functions.geo import haversine
from almanack.operators import stations as st
from almanack.operators.panel import pivot_wide


def daily_station_table(hourly, daily, stations, directions="mean_wind_dir", tasks=None):
    """All daily station values, long, with the distance to both samplers.

    Distances are computed on the station list and joined by site.  ``tasks``: into how many
    the values are dealt by site and date, where groups are as many as the rows.
    """
    rolled = st.hourly_to_daily(hourly.where(F.col("variable") != directions))
    wind = st.daily_direction(
        hourly.where(F.col("variable") == directions).withColumn("date", F.to_date("time")),
        ["site", "date"],
    ).withColumn("variable", F.lit(f"c_{directions}"))
    base = daily.select("site", "date", "variable", "value").unionByName(rolled).unionByName(wind)
    pair = base.where(F.col("variable").isin("c_max_air_temp", "c_min_air_temp"))
    if tasks:
        pair = pair.repartition(tasks, "site", "date")
    mean_temperature = pair.groupBy("site", "date").agg(
        st.strict_mean(F.col("value")).alias("value")
    ).withColumn("variable", F.lit("c_avg_air_temp"))
    placed = stations.select(
        "site",
        haversine(F.col("latitude"), F.col("longitude"), S.SAMPLER_LATER).alias("dist_lei"),
        haversine(F.col("latitude"), F.col("longitude"), S.SAMPLER_EARLIER).alias("dist_der"),
    ).distinct()
    # the stations are hashed, so the readings of a task are not sorted in its memory
    return base.unionByName(mean_temperature).join(placed.hint("shuffle_hash"), "site", "left")


def three_datasets(table, switch=S.STATION_SWITCH, flags=("c_thunder_day_flag",),
                   directions=("c_mean_wind_dir",), passed=("c_max_gust_dir",)):
    """``(dataset, variable, date, value, n_stations)``: nearest station, station
    mean and station median.  Directions become circular means.  In the mean set flags
    become any-station flags and ``passed`` variables come through as they are; the
    median set takes the plain median of both.

    The table is read by each of the branches below: pass a written one."""
    keys = ["variable", "date"]
    apart = [*flags, *directions, *passed]
    plain = table.where(~F.col("variable").isin(apart))
    flag = (
        table.where(F.col("variable").isin(list(flags)))
        .groupBy(*keys).agg(st.any_flag(F.col("value")).cast("double").alias("value"))
    )
    wind = st.daily_direction(table.where(F.col("variable").isin(list(directions))), keys)
    through = table.where(F.col("variable").isin(list(passed))).select(*keys, "value")
    middle = st.station_median(table.where(~F.col("variable").isin(list(directions))))
    distance = st.sampler_distance(F.col("date"), switch, F.col("dist_der"), F.col("dist_lei"))
    nearest = st.nearest_station(table.withColumn("_d", distance), "_d").select(*keys, "value")
    counts = st.station_counts(table)

    def averaged(df, name):
        return df.unionByName(wind).join(counts, keys, "left").withColumn("dataset", F.lit(name))

    return (
        averaged(st.station_mean(plain).unionByName(flag).unionByName(through), "station_mean")
        .unionByName(averaged(middle, "station_median"))
        .unionByName(
            nearest.withColumn("n_stations", F.lit(None).cast("long"))
            .withColumn("dataset", F.lit("nearest_station"))
        )
    )


def wide_dataset(datasets, name, variables):
    """One row per day of one dataset.  Of several nearest stations at one
    distance the mean is taken, so a cell has one value."""
    rows = datasets.where(F.col("dataset") == name).groupBy("date", "variable").agg(
        F.avg("value").alias("value")
    )
    return pivot_wide(rows, ["date"], "variable", "value", variables)


def consensus_weather(station_rows, wind, rules=None):
    """Station rows (with year, ring, site, date) and wind readings to one row per day.

    The rows are read twice, for the coverage and for the values: pass a written table."""
    chosen = st.choose_ring(station_rows, st.ring_coverage(station_rows))
    daily = st.consensus_daily(chosen, rules or S.CONSENSUS)
    mean_dir = st.daily_direction(wind, ["date"], "mean_wind_dir", "c_mean_wind_dir")
    gust_dir = st.daily_direction(wind, ["date"], "max_gust_dir", "c_max_gust_dir")
    speed = wind.groupBy("date").agg(
        F.avg("mean_wind_speed").alias("c_mean_wind_speed"),
        F.max(F.nanvl("max_gust_speed", F.lit(None).cast("double"))).alias("c_max_gust_speed"),
    )
    return daily.join(mean_dir, "date", "full").join(gust_dir, "date", "full").join(speed, "date", "full")
