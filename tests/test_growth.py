"""Queries on tables whose size or density differs from the given ones."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from almanack.operators import selection, stations as st
from almanack.operators.forests import tree_gains
from almanack.plans.forecast import selection_forest
from almanack.registry import ORACLES, QUERIES, fixtures as fx
from tests.compare import compare


def written(spark, tmp_path, name, rows, schema):
    """A folder with one table, and a DuckDB connection that sees it."""
    import duckdb

    path = f"{tmp_path}/{name}.parquet"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS FROM '{path}/*.parquet'")
    return str(tmp_path), con


def test_the_column_with_nulls_goes_however_dense_the_days(spark, tmp_path):
    days = [datetime(1995, 12, 30) + timedelta(days=i) for i in range(5)]
    rows = [(d, q) for d in days for q in (50.0, 3.0)] + [(days[0], None), (datetime(1997, 5, 5), None)]
    folder, con = written(spark, tmp_path, "lineitem", rows, "l_shipdate timestamp_ntz, l_quantity double")
    assert compare(QUERIES["drop_null_columns"](spark, folder), con, ORACLES["drop_null_columns"]) == []


def job_number(spark):
    """The number of the job it runs; numbers go up by one a job."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    spark.range(1).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return max(sc.statusTracker().getJobIdsForGroup("counted"))


def planted(spark, rows=400):
    """Two series whose label follows the first of six slots."""
    noise = lambda k: F.pmod(F.xxhash64("series", "id", F.lit(k)), F.lit(1000)) / 1000.0
    df = spark.range(rows).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("series"), "id")
    return df.select("series", "id", F.array(*[noise(k) for k in range(6)]).alias("slots"), (noise(0) > 0.7).cast("int").alias("y")).cache()


def test_a_round_of_selection_is_a_job_whatever_the_series_and_levels(spark):
    rows, names = planted(spark), [f"s{i}" for i in range(6)]
    forest = selection_forest("peak", depth=8, least=5)
    run = lambda **way: selection.slot_selection(rows, names, "y", forest, ["series", "id"], rounds=8, level=0.1, **way)
    rows.count()
    began = job_number(spark)
    found = run().collect()
    used = job_number(spark) - began
    assert used < 60
    for s in "ab":
        decided = {r.feature: r.decision for r in found if r.series == s}
        assert decided["s0"] == "confirmed" and "confirmed" not in [decided[n] for n in names[1:]]
    assert run().collect() == found
    # series too large for a task are fitted by Spark ML and decided alike
    other = run(in_task=0).collect()
    assert [r.feature for r in other if r.decision == "confirmed"] == ["s0", "s0"]


def test_gains_of_trees_equal_those_of_plain_sums():
    rng = np.random.default_rng(3)
    bins, y = rng.integers(1, 9, (200, 5)).astype(np.uint8), rng.random(200)
    weights = rng.poisson(1.0, (3, 200))
    got = tree_gains(bins, y, weights, rng, 5, 1, 20)

    def spread(own, w):
        return (w[own] * (y[own] - np.average(y[own], weights=w[own])) ** 2).sum()

    for w, gains in zip(weights, got):
        every = np.full(200, True)
        best = max(
            (spread(every, w) - spread(left, w) - spread(~left, w), s)
            for s in range(5) for cut in range(1, 8) for left in [bins[:, s] <= cut]
            if w[left].sum() >= 20 and w[~left].sum() >= 20)
        assert np.flatnonzero(gains).tolist() == [best[1]] and np.isclose(gains[best[1]], best[0])
    assert not tree_gains(bins, y, weights, rng, 5, 4, 200).any()


def test_tasks_of_the_shadows_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(selection, "RANGE_ROWS", 1 << 8)
    df = spark.range(20_000).select("id", (F.col("id") * 1.0).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") * 2.0).alias("y"))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = selection.with_shadows(df, ["x", "y"], ["id"], 7)
        most = max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert most < 4 * selection.RANGES_A_TASK * 256
        rows = got.toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for c in "xy":
        assert sorted(rows[c].dropna()) == sorted(rows[f"shadow_{c}"].dropna())
        assert (rows[c] != rows[f"shadow_{c}"]).mean() > 0.9


def test_tasks_of_station_days_follow_the_readings(spark, tmp_path, monkeypatch):
    day = datetime(2000, 1, 1)
    rows = [(s, day + timedelta(days=s % 7), "A", 2.0) for s in range(4000)]
    folder, _ = written(spark, tmp_path, "lineitem", rows, "l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double")
    monkeypatch.setattr(fx, "STATION_ROWS", 100, raising=False)
    daily = fx.station_daily(spark, folder)
    sizes = [r["count"] for r in daily.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 300


def test_only_the_nearest_stations_are_ranked(spark):
    rows = [("a", 1, 2.0), ("a", 2, 1.0), ("a", 3, 1.0), ("a", 4, None), ("b", 5, None), ("b", 6, float("nan")), ("c", 7, None), ("c", 8, None), (None, 9, 3.0), (None, 10, 4.0), ("d", 11, -0.0), ("d", 12, 0.0)]
    df = spark.createDataFrame(rows, "variable string, site int, d double").withColumn("date", F.lit("x"))
    near = st.nearest_station(df, "d")
    assert sorted(r.site for r in near.collect()) == [2, 3, 6, 7, 8, 9, 11, 12]
    assert "LeftSemi" in near._jdf.queryExecution().optimizedPlan().toString()
