"""Grouped numerics, components, splits and sampling against brute force."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.operators import bagging, outliers as ou, selection, tsnumeric as tn, walkforward as wf
from almanack.operators.tsfeatures import memory_features, shape_features, smoothing_features

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def period(spark):
    x = RNG.gamma(2, 10, 90).round(1)
    rows = [("a", "p", date(2020, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "series string, period string, date date, value double")


def test_shape_features(period):
    x, df = period
    got = shape_features(df).first().asDict()
    n, k = len(x), len(x) // 20 + 1
    chunks = np.array_split(x, k)
    median = x <= np.median(x)
    assert np.isclose(got["std1st_der"], np.std(np.gradient(x)))
    assert got["crossing_points"] == np.sum(median[1:] != median[:-1])
    assert np.isclose(got["binarize_mean"], np.mean(x > x.mean()))
    assert np.isclose(got["lumpiness"], np.var([np.var(c) for c in chunks]))
    assert np.isclose(got["stability"], np.var([np.mean(c) for c in chunks]))
    assert np.isclose(got["linearity"], np.corrcoef(x, np.arange(n))[0, 1] ** 2)
    rolling = np.array([x[i : i + 20].mean() for i in range(n - 19)])
    moved = np.abs(np.diff(rolling))
    assert got["level_shift_idx"] == np.argmax(np.round(moved, 9))
    assert np.isclose(got["level_shift_size"], moved.max())
    assert 0 <= got["trend_strength"] <= 1


def test_memory_features(period):
    x, df = period
    got = memory_features(df).first().asDict()

    def acf(v, k):
        c = v - v.mean()
        return (c[k:] @ c[:-k]) / (c @ c)

    for name, v in [("y", x), ("diff1y", np.diff(x)), ("diff2y", np.diff(x, 2))]:
        assert np.isclose(got[f"{name}_acf1"], acf(v, 1))
        assert np.isclose(got[f"{name}_acf5"], sum(acf(v, k) ** 2 for k in range(1, 6)))
    assert np.isclose(got["seas_acf1"], acf(x, 7))
    lags = np.arange(2, 30)
    sd = [np.std(x[k:] - x[:-k]) for k in lags]
    assert np.isclose(got["hurst"], np.polyfit(np.log(lags), np.log(sd), 1)[0])
    t = np.arange(len(x))
    e = x - np.polyval(np.polyfit(t, x, 1), t)
    lag = int(np.ceil(3 * np.sqrt(len(x)) / 13))
    s2 = (e @ e + 2 * sum((e[i:] @ e[:-i]) * (1 - i / (lag + 1)) for i in range(1, lag + 1))) / len(x)
    assert np.isclose(got["unitroot_kpss"], (np.cumsum(e) ** 2).sum() / len(x) ** 2 / s2)


def test_partial_autocorrelations_as_columns(period):
    x, df = period
    got = memory_features(df).first().asDict()
    for name, v in [("y_pacf5", x), ("diff1y_pacf5", np.diff(x)), ("diff2y_pacf5", np.diff(x, 2))]:
        assert np.isclose(got[name], tn.sum_of_squares(v, 5))
    assert np.isclose(got["seas_pacf1"], tn.partial_autocorrelation(x, 7)[6])


def test_heterogeneity_is_the_fit_of_squares_on_earlier_ones(period):
    x, df = period
    z = (x - x.mean()) ** 2
    left = np.column_stack([np.ones(len(z) - 4), *[z[4 - k : len(z) - k] for k in range(1, 5)]])
    rest = z[4:] - left @ np.linalg.lstsq(left, z[4:], rcond=None)[0]
    want = len(rest) * (1 - rest.var() / z[4:].var())
    assert np.isclose(memory_features(df).first()["heterogeneity"], want)


def test_heterogeneity_passes_over_a_regressor_without_spread(spark):
    rows = [("a", "p", date(2020, 1, 1) + timedelta(days=i), float(i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "series string, period string, date date, value double")
    assert memory_features(df).first()["heterogeneity"] is None


def test_crossings_of_the_autocorrelation(period):
    x, df = period
    c = x - x.mean()
    r = np.round([c[k:] @ c[: len(c) - k] / (c @ c) for k in range(len(c))], 9)
    got = memory_features(df).first()
    assert got["firstzero_ac"] == next(k for k in range(1, len(r)) if r[k] <= 0)
    assert got["firstmin_ac"] == next(k for k in range(1, len(r) - 1) if r[k] < r[k - 1] and r[k] < r[k + 1])


def test_spikiness_leaves_out_each_row_once(spark):
    x = np.random.default_rng(5).normal(size=40).cumsum()
    rows = [("a", "p", date(2020, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series string, period string, date date, value double")
    trend = np.array([x[max(0, i - 3) : i + 4].mean() for i in range(40)])
    rest = x - trend
    for k in range(7):
        rest[k::7] -= (x - trend)[k::7].mean()
    loo = [np.var(np.delete(rest, i), ddof=1) for i in range(40)]
    assert np.isclose(shape_features(df).first()["spikiness"], np.var(loo, ddof=1))


@pytest.mark.parametrize("n", [1, 3, 4, 40])
def test_smoothing_as_a_fold_equals_the_loop(spark, n):
    x = np.random.default_rng(n).normal(size=n).cumsum()
    rows = [("a", "p", date(2020, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series string, period string, date date, value double")
    got = smoothing_features(df.repartition(3)).first()["holt_alpha"]
    assert got == tn.holt_level(x) and (got is None) == (n < 4)


def test_features_of_flat_and_short_periods(spark):
    rows = [("a", p, date(2020, 1, 1) + timedelta(days=i), v) for p, n, v in [("flat", 20, 3.0), ("one", 1, 2.0), ("two", 2, 2.0)] for i in range(n)]
    df = spark.createDataFrame(rows, "series string, period string, date date, value double")
    got = {r["period"]: r for r in memory_features(df).collect()}
    assert set(got) == {"flat", "one", "two"}
    for r in got.values():
        assert all(r[c] is None for c in ("y_pacf5", "seas_pacf1", "heterogeneity", "firstzero_ac", "firstmin_ac"))


def test_partial_autocorrelation_of_an_autoregression():
    e = RNG.normal(size=4000)
    x = np.zeros(4000)
    for i in range(1, 4000):
        x[i] = 0.6 * x[i - 1] + e[i]
    p = tn.partial_autocorrelation(x, 3)
    assert abs(p[0] - 0.6) < 0.05 and np.abs(p[1:]).max() < 0.05
    assert tn.partial_autocorrelation(np.ones(50), 3) is None


def test_spectral_entropy_bounds():
    t = np.arange(256)
    assert tn.spectral_entropy(np.ones(30)) == 0.0
    assert tn.spectral_entropy(np.sin(2 * np.pi * t / 16)) < 0.05
    assert 0.8 < tn.spectral_entropy(RNG.normal(size=256)) <= 1.0


def test_smoothing_level_has_the_least_error():
    x = RNG.normal(size=40).cumsum()

    def error(alpha, beta):
        level, trend, total = x[0], x[1] - x[0], 0.0
        for v in x[1:]:
            expected = level + trend
            total += (v - expected) ** 2
            moved = expected + alpha * (v - expected)
            level, trend = moved, trend + beta * (moved - level - trend)
        return total

    best = min((round(error(a, b), 9), a) for a in tn.GRID for b in tn.GRID)
    assert tn.holt_level(x) == best[1]
    assert tn.holt_level(x[:3]) is None


def test_components_find_the_odd_period(spark):
    rows = []
    for p in range(40):
        base = RNG.normal(size=6)
        if p == 17:
            base = base + 25
        rows += [("a", f"{p:02d}", f"f{i}", float(v)) for i, v in enumerate(base)]
        rows.append(("a", f"{p:02d}", "entropy", 0.0 if p == 3 else 0.5 + p / 100))
        rows.append(("a", f"{p:02d}", "broken", None if p == 5 else 1.0))
    df = spark.createDataFrame(rows, "series string, period string, feature string, value double")
    assert [r["period"] for r in ou.pca_outliers(df, 3.2).collect()] == ["17"]
    scores = ou.component_scores(df)
    assert scores.where("period = '03'").count() == 0
    assert scores.select("feature").distinct().count() == 7


@pytest.mark.parametrize("years, starts", [(1, 1), (9, 9), (10, 9), (46, 9)])
def test_split_table_matches_time_series_splits(spark, years, starts):
    days = spark.range(1).select(
        F.lit("a").alias("series"),
        F.explode(F.sequence(F.lit(date(1970, 1, 1)), F.lit(date(1970 + years - 1, 12, 31)))).alias("date"),
    )
    table = [r.asDict() for r in wf.split_table(days).orderBy("start_year", "fold").collect()]
    assert len({r["start_year"] for r in table}) == starts
    total = days.count()
    for i, start in enumerate(sorted({r["start_year"] for r in table})):
        assert start == 1970 + i * (years // starts)
        left = total - (date(start, 1, 1) - date(1970, 1, 1)).days
        k = i + 2
        size = left // (k + 1)
        expected = [(left - (k - j) * size, left - (k - j - 1) * size) for j in range(k)]
        got = [(r["test_lo"], r["test_hi"]) for r in table if r["start_year"] == start]
        assert got == expected
        assert all(r["train_rows"] == r["test_lo"] for r in table)


def test_undersampling_keeps_positives_and_repeats(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 50 == 0).cast("int").alias("y"))
    bag = bagging.undersample(df, "y", ["k"], 1, 0.1)
    assert bag.where("y = 1").count() == 400
    assert abs(bag.where("y = 0").count() - 4000) < 300
    assert bag.exceptAll(bagging.undersample(df.repartition(13), "y", ["k"], 1, 0.1)).isEmpty()
    assert not bag.exceptAll(bagging.undersample(df, "y", ["k"], 2, 0.1)).isEmpty()


@pytest.mark.parametrize("rows", [1, 300, 30_000])
def test_shadows_are_permutations_of_all_rows(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") * 1.5).alias("x"), (F.col("id") % 7).alias("y"))
    got = selection.with_shadows(df, ["x", "y"], ["id"], 5).toPandas()
    assert sorted(got["shadow_x"]) == sorted(got["x"]) and sorted(got["shadow_y"]) == sorted(got["y"])
    if rows > 1:
        assert abs(np.corrcoef(got["x"], got["shadow_x"])[0, 1]) < 0.2
        assert abs(np.corrcoef(got["shadow_x"] / 1.5 % 7, got["shadow_y"])[0, 1]) < 0.2


def test_shadow_selection_separates_signal_from_noise(spark):
    from almanack.plans.forecast import selection_forest

    df = spark.range(600).select(
        "id", F.randn(1).alias("signal"), F.randn(2).alias("noise"), F.randn(3).alias("noise2")
    ).withColumn("y", (F.col("signal") > 0).cast("int"))
    forest = selection_forest("peak", trees=10, depth=4)
    rows = selection.shadow_selection(df, ["signal", "noise", "noise2"], "y", forest, ["id"], rounds=8, level=0.1)
    found = {r["feature"]: r["decision"] for r in rows.collect()}
    assert found["signal"] == "confirmed" and found["noise"] != "confirmed"


def test_binomial_tail():
    assert selection.binomial_tail(0, 5) == 1.0
    assert selection.binomial_tail(5, 5) == 1 / 32


def test_search_is_stored_and_found_again(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql.types import StructType

    from almanack.plans.forecast import stored_parameters, tune_peaks
    from almanack.registry.models import _RESULTS

    days = spark.range(1200).select(
        F.lit("a").alias("series"), F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.randn(4).alias("x"),
    ).withColumn("peak", (F.col("x") > 0.8).cast("int"))
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(days)
    root = str(tmp_path / "tuning")
    best = tune_peaks(train, {"bags": [1], "depth": [1, 2], "trees": [2]}, root, "01012024_1200", max_starts=1)
    spark.read.parquet(f"{root}/run_ts=01012024_1200").withColumn("params", F.lit("{}")).write.parquet(
        f"{root}/run_ts=31122023_2359"
    )
    assert stored_parameters(spark, root, StructType.fromDDL(_RESULTS), "a") == best["a"]


def test_search_keeps_series_apart(spark):
    days = spark.range(800).select(
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("series"),
        F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("date"),
        (F.col("id") % 2).cast("int").alias("peak"),
    )
    seen = []

    def fit(train, depth):
        seen.append((depth, {r["series"] for r in train.select("series").distinct().collect()}))

    def predict(model, test):
        return test.withColumn("prediction", F.col("peak"))

    results, best = wf.forward_walk_search(days, {"depth": [1, 2]}, fit, predict, "peak", max_starts=1)
    assert all(len(s) == 1 for _, s in seen) and {"a", "b"} == set(best)
    assert {r["series"] for r in results.collect()} == {"a", "b"}
