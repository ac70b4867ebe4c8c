"""Many stations, one day: roll-ups, consensus, nearest and best-covered stations."""

from pyspark.sql import Window, functions as F

from almanack.functions.angles import circular_mean, valid_direction
from almanack.functions.medians import agg_with_median
from almanack.settings import MIN_STATIONS, RING_KM


def hourly_to_daily(readings, keys=("site", "date")):
    """Long daily max, min, mean and median per site and variable.

    Input ``(site, time, variable, value)``; output variables are named
    ``c_max_<variable>`` and so on.  A day without readings is null.
    """
    group = [*keys, "variable"]
    stats = agg_with_median(
        readings.withColumn("date", F.to_date("time")), group, "value", "med",
        F.max("value").alias("max"), F.min("value").alias("min"), F.avg("value").alias("avg"),
    )
    return stats.unpivot(group, ["max", "min", "avg", "med"], "stat", "value").select(
        *keys, F.concat(F.lit("c_"), "stat", F.lit("_"), "variable").alias("variable"), "value"
    )


def daily_direction(readings, keys, value="value", name="value"):
    """Circular mean per group; faulty and missing directions are left out first."""
    return (
        readings.withColumn("_d", valid_direction(F.col(value)))
        .where(F.col("_d").isNotNull())
        .groupBy(*keys)
        .agg(circular_mean(F.col("_d")).alias(name))
    )


def station_mean(df, keys=("variable", "date")):
    return df.groupBy(*keys).agg(F.avg("value").alias("value"))


def station_median(df, keys=("variable", "date")):
    return agg_with_median(df, list(keys), "value", "value")


def any_flag(flag):
    """Aggregate: 1 if any station raised the flag, null only if none reported."""
    return F.max(F.when(flag > 0, 1).when(flag.isNotNull(), 0))


def strict_mean(value):
    """Aggregate: mean that is null as soon as one input is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def consensus_daily(df, rules, keys=("date",)):
    """One aggregate per column, named ``c_<column>``; ``rules`` maps column to
    ``max``, ``min``, ``avg`` or ``any``."""
    how = {"max": F.max, "min": F.min, "avg": F.avg, "any": any_flag}
    return df.groupBy(*keys).agg(
        *[how[rule](F.col(c)).alias(f"c_{c}") for c, rule in rules.items()]
    )


def station_counts(df, keys=("variable", "date")):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_stations"))


def most_stations(counts, period):
    """Largest daily count per variable and ``period`` columns."""
    return counts.groupBy("variable", *period).agg(F.max("n_stations").alias("n_stations"))


def ring(distance_km, limit=RING_KM):
    return F.when(distance_km >= limit, "extra").when(distance_km < limit, "intra")


def ring_coverage(df, minimum=MIN_STATIONS):
    """Distinct stations per year in each ring, and the ring to use.

    The outer ring is used where the inner one has fewer than ``minimum``.
    Stations are deduplicated before counting, so a station's rows never meet in
    one place.
    """
    counted = (
        df.where(F.col("ring").isNotNull())
        .select("year", "ring", "site")
        .distinct()
        .groupBy("year")
        .agg(
            F.nullif(F.count_if(F.col("ring") == "intra"), F.lit(0)).alias("intra"),
            F.nullif(F.count_if(F.col("ring") == "extra"), F.lit(0)).alias("extra"),
        )
    )
    few = F.coalesce(F.col("intra"), F.lit(0)) < minimum
    return counted.withColumn("ring", F.when(few, "extra").otherwise("intra"))


def choose_ring(df, coverage):
    """Rows of the chosen ring of their year."""
    return df.join(coverage.select("year", "ring"), ["year", "ring"], "left_semi")


def sampler_distance(day, switch, before, after):
    """The sampler moved once, so the distance that counts depends on the date."""
    return F.when(day < F.lit(switch), before).otherwise(after)


def nearest_station(df, distance, keys=("variable", "date")):
    """Rows of the closest station per group, ties kept.

    Groups' least distances, one row a group, are joined to the rows as they are read, so
    the rank, whose filter is a group limit, sorts the closest rows alone.
    """
    least = df.groupBy(*keys).agg(F.min(distance).alias("_least"))
    least = least.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = F.col(distance).eqNullSafe(F.col("_least"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    df = df.join(least.hint("broadcast"), same, "left_semi")
    w = Window.partitionBy(*keys).orderBy(F.col(distance).asc_nulls_last())
    return df.withColumn("_r", F.rank().over(w)).where("_r = 1").drop("_r")


def station_join(stations, temperature, rain, weather, radiation, distance, start, end,
                 period="pm", max_km=None, limit=RING_KM):
    """Five relations joined on station and date for one sampler."""
    sampler = (distance, start, end, max_km, None)
    rows = samplers_join(stations, temperature, rain, weather, radiation, [sampler], period, limit)
    return rows.drop("sampling_site")


def samplers_join(stations, temperature, rain, weather, radiation, samplers, period="pm", limit=RING_KM):
    """Five relations joined on station and date, once for all samplers.

    ``samplers``: ``(distance column, start, end, largest distance or None, name)``; their
    dates must not overlap, so a row's date says which sampler it is for.

    Written as full joins; the filters on period and date reject nulls, so Catalyst
    narrows them to inner and left joins and pushes the dates and keys down to every
    scan.
    """
    spans = sorted((str(start), str(end)) for _, start, end, _, _ in samplers)
    if any(late >= early for (_, late), (early, _) in zip(spans, spans[1:])):
        raise ValueError("samplers overlap in time")
    s, t, r, w, g = (
        stations.alias("s"), temperature.alias("t"), rain.alias("r"),
        weather.alias("w"), radiation.alias("g"),
    )

    def same_day(other):
        return (F.col("t.date") == F.col(f"{other}.date")) & (
            F.col("t.src_id") == F.col(f"{other}.src_id")
        )

    day = F.col("t.date")
    near, name, kept = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(False)
    for distance, start, end, max_km, site in samplers:
        own = day.between(F.lit(start), F.lit(end))
        near = F.when(own, F.col(f"s.{distance}")).otherwise(near)
        name = F.when(own, F.lit(site)).otherwise(name)
        kept = kept | (own if max_km is None else own & (F.col(f"s.{distance}") <= max_km))
    joined = (
        s.join(t, F.col("s.src_id") == F.col("t.src_id"), "full")
        .join(r, same_day("r"), "full")
        .join(w, same_day("w"), "full")
        .join(g, same_day("g"), "full")
        .where((F.col("w.end_period") == period) & day.between(F.lit(spans[0][0]), F.lit(spans[-1][1])))
        .where(kept)
    )

    def measures(df, name):
        return [
            F.col(f"{name}.{c}") for c in df.columns
            if c not in ("src_id", "date", "end_period")
        ]

    return joined.select(
        F.coalesce("s.src_id", "t.src_id").alias("src_id"),
        F.col("s.observation_station").alias("site"),
        near.alias("station_distance_km"),
        ring(near, limit).alias("ring"),
        day.alias("date"),
        *measures(temperature, "t"), *measures(rain, "r"),
        *measures(weather, "w"), *measures(radiation, "g"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        name.alias("sampling_site"),
    )
