"""Selection over slots, the search of bags, stored stages and runs, on small frames."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.operators import selection as se
from almanack.plans import forecast as fc
from almanack.plans.features import exclusions_before
from almanack.sources import runs

CUT = date(2003, 1, 1)


@pytest.fixture(scope="module")
def frame(spark):
    """Two series of four years whose peaks follow ``x`` and a wind class; one feature is
    missing on some days before and after the cut."""
    days = spark.range(1461).select(
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("series"), F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("date"), "id")
    noise = lambda k: (F.pmod(F.xxhash64("series", "id", F.lit(k)), F.lit(1000)) / 1000.0)
    df = days.withColumns({"x": noise(1), "noise": noise(2), "month": F.month("date"), "c_mean_wind_dir_class": (noise(3) * 4).cast("int")})
    peak = ((F.col("x") > 0.8) & (F.col("c_mean_wind_dir_class") == 1)) | ((F.col("x") > 0.97))
    df = df.withColumn("peak", peak.cast("int")).withColumn("outcome", 10 * F.col("x") + F.col("peak") * 5)
    gap = F.when(F.col("id") % 97 != 0, F.col("noise"))
    return df.withColumn("noise", gap).drop("id").cache()


@pytest.fixture(scope="module")
def binned(frame):
    return fc.Binned(frame, CUT)


def test_days_with_gaps_are_predicted(frame, binned):
    peaks, _ = fc.peaks_of_all(binned)
    late = frame.where(F.col("date") >= F.lit(CUT))
    assert peaks.select("series", "date").exceptAll(late.select("series", "date")).isEmpty() and peaks.count() == late.count()
    assert peaks.where("prediction IS NULL").isEmpty()
    right = peaks.where("prediction = peak").count()
    assert right > 0.9 * peaks.count()


def test_one_hot_slots_can_be_confirmed_and_feed_the_models(frame):
    found = fc.selected_slots(frame, CUT, "peak", rounds=10, level=0.05, depth=4)
    assert found.columns == ["series", "feature", "hits", "rounds", "decision"]
    chosen = se.confirmed_slots(found)
    assert set(chosen) == {"a", "b"}
    for names in chosen.values():
        assert "x" in names and "c_mean_wind_dir_class_is_1" in names and "noise" not in names
    binned = fc.Binned(frame, CUT)
    only = [binned.names.index(n) for n in chosen["a"]]
    assert binned.allowed({"a": chosen["a"]})[0] == tuple(sorted(only))
    assert binned.allowed({"a": chosen["a"]})[1] == tuple(range(len(binned.names)))
    _, stumps = fc.peaks_of_all(binned, {"a": ["x"], "b": ["x"]}, {s: {"rounds": 5} for s in "ab"})
    used = {int(s) for t in stumps.trees for s in np.unique(t.slot) if s >= 0}
    assert used == {binned.names.index("x")}


def test_shadows_permute_every_slot_within_its_series(spark):
    rows = spark.range(300).select(F.when(F.col("id") < 100, "a").otherwise("b").alias("series"), "id", F.array(F.col("id") * 1.0, F.col("id") % 7 * 1.0).alias("slots"))
    for bits in (1, 6):
        got = se.with_slot_shadows(rows, ["series", "id"], 3, bits).collect()
        assert len(got) == 300
        for s in "ab":
            own = [r for r in got if r.series == s]
            for slot in (0, 1):
                assert sorted(r.shadows[slot] for r in own) == sorted(r.slots[slot] for r in own)
            assert sum(r.shadows[0] != r.slots[0] for r in own) > 0.9 * len(own)
            joint = sum(r.shadows[0] % 7 == r.shadows[1] for r in own)
            assert joint < 0.4 * len(own)


def test_counts_draw_columns_as_told(binned):
    counts, (start, trees) = fc.counts_of_all(binned, trees=6, depth=3)
    assert counts.columns == ["series", "date", "prediction", "outcome"] and len(trees) == 6 and len(start) == 2
    slots, draw = len(binned.names), fc.Draw(len(binned.names), 0.2, 0.7, 42)
    for number, tree in enumerate(trees):
        for model in range(2):
            for node in np.flatnonzero(tree.slot[model] >= 0):
                level = int(np.log2(node + 1))
                assert tree.slot[model, node] in draw.of(model, number, level)
        assert len(np.unique(tree.slot[0][tree.slot[0] >= 0])) <= max(1, int(0.2 * slots))


def test_stored_stages_predict_the_same(spark, frame, binned, tmp_path):
    peaks, stumps = fc.peaks_of_all(binned, params={s: {"rounds": 7, "bags": 3} for s in "ab"})
    counts, model = fc.counts_of_all(binned, trees=4, depth=2)
    fc.save_stage(binned, "peaks", stumps, f"{tmp_path}/p")
    fc.save_stage(binned, "counts", model, f"{tmp_path}/c")
    late = frame.where(F.col("date") >= F.lit(CUT))
    assert fc.StoredStage(spark, f"{tmp_path}/p").peaks(late).exceptAll(peaks).isEmpty()
    assert fc.StoredStage(spark, f"{tmp_path}/c").counts(late).exceptAll(counts).isEmpty()


@pytest.mark.parametrize("quiet", [["a"], ["a", "b"]])
def test_stored_stages_predict_the_same_where_no_day_is_a_peak(spark, frame, tmp_path, quiet):
    flat = frame.withColumn("peak", F.when(~F.col("series").isin(quiet), F.col("peak")).otherwise(0))
    own = fc.Binned(flat, CUT)
    peaks, stumps = fc.peaks_of_all(own, params={s: {"rounds": 3, "bags": 3} for s in "ab"})
    fc.save_stage(own, "peaks", stumps, f"{tmp_path}/p")
    late = flat.where(F.col("date") >= F.lit(CUT))
    stored = fc.StoredStage(spark, f"{tmp_path}/p").peaks(late)
    assert stored.count() == late.count() and stored.exceptAll(peaks).isEmpty()
    assert stored.where(F.col("series").isin(quiet) & ~F.col("prediction").eqNullSafe(0)).isEmpty()


def test_search_covers_starts_folds_and_settings(frame):
    binned = fc.Binned(frame, CUT, years=True)
    assert binned.names[-1] == "year"
    folds, table, best = fc.search_of_all(binned, {"bags": [2], "ratio": [0.5, 1.0], "rounds": [2, 6]}, at_once=7)
    rows = folds.collect()
    assert len(rows) == 2 * (2 + 3 + 4) * 4
    assert {(r.start_year, r.fold) for r in rows} == {(2000 + i, f + 1) for i in range(3) for f in range(i + 2)}
    assert all(r.train_sensitivity is not None for r in rows)
    chosen = {r.series: r.params for r in best.collect()}
    for s, params in chosen.items():
        top = max((r for r in table.collect() if r.series == s), key=lambda r: r.mean_test_precision)
        mean = {}
        for r in rows:
            if r.series == s and r.params == params:
                mean.setdefault(r.start_year, []).append(r.test_precision or 0.0)
        assert np.isclose(max(np.mean(v) for v in mean.values()), top.mean_test_precision)


def test_a_run_without_its_record_is_not_read(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert runs.newest_run(spark, root) is None
    spark.range(1).write.parquet(f"{root}/data/half")
    assert runs.newest_run(spark, root) is None
    with pytest.raises(ZeroDivisionError):
        runs.store_run(spark, root, "05052030_0000", lambda place: 1 / 0)
    runs.store_run(spark, root, "02012024_0900", spark.range(2).write.parquet)
    runs.store_run(spark, root, "31122023_2359", spark.range(3).write.parquet)
    again = runs.store_run(spark, root, "02012024_0900", spark.range(4).write.parquet)
    assert runs.newest_run(spark, root) == again and spark.read.parquet(again).count() == 4


def test_parameters_tuned_else_stored_else_default(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "series string")
    table = lambda rows: spark.createDataFrame(rows, "series string, params string")
    got = runs.chosen_parameters(names, "d", table([("a", "s"), ("b", "s"), ("z", "s")]), table([("a", "t")]))
    assert sorted(map(tuple, got.collect())) == [("a", "t", "tuned"), ("b", "s", "stored"), ("c", "d", "default")]
    assert {r.origin for r in runs.chosen_parameters(names, "d").collect()} == {"default"}


def test_exclusions_do_not_see_the_split(spark):
    days = spark.range(365 * 6).select(
        F.lit("a").alias("series"), F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("date"), (F.pmod(F.xxhash64("id"), F.lit(50)) * 1.0).alias("value"))
    odd = days.withColumn("value", F.when(F.year("date") == 2002, 1000.0 - F.col("value") * 9).otherwise(F.col("value")))
    given = spark.createDataFrame([("a", 2004), ("b", 1990)], "series string, year int")
    cut = date(2005, 1, 1)
    got = {tuple(r) for r in exclusions_before(odd, cut, given, 1.999).collect()}
    assert ("a", 2002) in got and ("a", 2004) in got and ("b", 1990) in got
    later = odd.withColumn("value", F.when(F.col("date") >= F.lit(cut), 1e6).otherwise(F.col("value")))
    assert {tuple(r) for r in exclusions_before(later, cut, given, 1.999).collect()} == got
