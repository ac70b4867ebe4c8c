"""Hand-made frames for the cases the given tables do not hold."""

import math
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanack.functions import dates, numeric
from almanack.functions.angles import circular_mean, direction_class
from almanack.functions.geo import haversine
from almanack.functions.medians import agg_with_median, counted_median
from almanack.operators import impute as im, panel as pn, seasons, stations as st, windows as wn
from almanack.operators.effects import class_effect_rank
from almanack.operators.gaps import coalesce_sources
from almanack.operators.neighbours import with_other_sum
from almanack.operators.peaks import flag_peaks, peak_thresholds


def values(df, column="value", order=("series", "date")):
    return [r[column] for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize(
    "degrees, expected",
    [(348.75, 1), (11.25, 2), (11.2499, 1), (360.0, 1), (-5.0, 1), (400.0, 1), (348.74, 16),
     (180.0, 9), (0.0, 1), (None, None), (float("nan"), None)],
)
def test_direction_class(spark, degrees, expected):
    df = spark.createDataFrame([(degrees,)], "d double")
    assert df.select(direction_class(F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    "degrees, expected", [([350, 10], 0), ([0, 180], None), ([90, 90, 90], 90), ([270, 280], 275)]
)
def test_circular_mean(spark, degrees, expected):
    df = spark.createDataFrame([(float(d),) for d in degrees], "d double")
    got = df.agg(circular_mean(F.col("d"))).first()[0]
    if expected is None:
        assert got is None
    else:
        assert math.isclose((got - expected + 180) % 360, 180, abs_tol=1e-9)


def test_faulty_directions_are_left_out(spark):
    df = spark.createDataFrame([("a", 361.0), ("a", None), ("a", 40.0), ("b", 999.0)], "k string, value double")
    got = {r["k"]: r["value"] for r in st.daily_direction(df, ["k"]).collect()}
    assert list(got) == ["a"] and math.isclose(got["a"], 40.0)


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(29.5, 24.5, 24.5), (10.0, 5.0, 20.0), (None, 5.0, 1.0)], "a double, b double, base double")
    got = [r[0] for r in df.select(numeric.growing_degree_days(F.col("a"), F.col("b"), F.col("base"))).collect()]
    assert got == [2.5, 0.0, None]
    assert spark.range(1).select(F.bround(F.lit(2.5), 0), F.bround(F.lit(3.5), 0)).first()[:] == (2.0, 4.0)


def test_calendar_parts(spark):
    days = [date(2019, 12, 30), date(2021, 1, 3), date(2020, 2, 29)]
    df = dates.with_calendar_parts(spark.createDataFrame([(d,) for d in days], "date date"))
    got = [(r["DoY"], r["week_1"]) for r in df.collect()]
    assert got == [(364, 1.0), (3, 53.0), (60, 9.0)]


def test_day_first_text(spark):
    df = spark.createDataFrame([("03-04-1999",), ("3/4/1999",), ("rubbish",), (None,)], "t string")
    assert [r[0] for r in df.select(dates.day_first(F.col("t"))).collect()] == [date(1999, 4, 3)] * 2 + [None] * 2


def test_haversine_one_degree(spark):
    df = spark.createDataFrame([(53.0, -1.0)], "lat double, lon double")
    got = df.select(haversine(F.col("lat"), F.col("lon"), (52.0, -1.0))).first()[0]
    assert math.isclose(got, 6378137 * math.radians(1), rel_tol=1e-9)


# -- medians ----------------------------------------------------------------


@pytest.mark.parametrize("size", [7, 5000, 40_000])
def test_medians_of_any_group_size(spark, size):
    rows = spark.range(size).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 200)).alias("k"),
        ((F.xxhash64("id") % 1000) / 7.0).alias("v"),
    ).unionByName(
        spark.createDataFrame([("empty", None), ("one", -3.5), (None, 4.0), (None, 5.0)], "k string, v double")
    )
    expected = {r["k"]: r["m"] for r in rows.groupBy("k").agg(F.median("v").alias("m")).collect()}
    got = agg_with_median(rows, ["k"], "v", "m")
    assert {r["k"]: r["m"] for r in got.collect()} == expected
    both = agg_with_median(rows, ["k"], "v", "m", F.count("v").alias("n"))
    assert {r["k"]: r["m"] for r in both.collect()} == expected


@pytest.mark.parametrize("copies", [1, 3000])
def test_medians_order_nan_infinities_and_zeros_one_way(spark, copies):
    nan, inf = float("nan"), float("inf")
    cases = {"a": [-5.0, 3.0, 4.0, 9.0, nan], "b": [-inf, 1.0, inf], "c": [-inf, -inf, 7.0], "d": [-0.0, 0.0, None], "e": [nan]}
    rows = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k string, v double")
    rows = rows.crossJoin(spark.range(copies)).drop("id")
    got = {r["k"]: r["m"] for r in agg_with_median(rows, ["k"], "v", "m").collect()}
    assert math.isnan(got.pop("e")) and got == {"a": 4.0, "b": 1.0, "c": -inf, "d": 0.0}


def test_counted_median_with_ties(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [0, 0, 0, 5, 5, 1e300, -1e300, 2]], "k string, v double")
    assert counted_median(df, ["k"], "v", "m").first()["m"] == 1.0


# -- gaps -------------------------------------------------------------------


def test_grid_rejects_two_rows_on_a_day(spark, series_frame):
    df = series_frame({"a": [1, 2]}).unionByName(series_frame({"a": [3]}))
    with pytest.raises(Exception, match="two rows for one series and date"):
        pn.dense_grid(df, date(2019, 1, 1), date(2019, 1, 5)).collect()


def test_grid_keeps_a_series_without_rows_in_the_range(spark, series_frame):
    df = series_frame({"a": [1, 2]}).unionByName(series_frame({"b": [3]}, date(2018, 1, 1)))
    grid = pn.dense_grid(df, date(2019, 1, 1), date(2019, 1, 3)).collect()
    assert sorted((r["series"], r["date"].day, r["value"]) for r in grid if r["series"] == "a") == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, None)]
    assert sorted((r["date"].day, r["value"]) for r in grid if r["series"] == "b") == [(1, None), (2, None), (3, None)]
    missing = pn.missing_dates(df, date(2019, 1, 1), date(2019, 1, 3)).where("series = 'b'")
    assert missing.count() == 3


def test_other_sum_keeps_small_values_beside_large_ones(spark, series_frame):
    df = series_frame({"a": [1e17], "b": [3.0], "c": [0.5], "d": [float("inf")]})
    got = {r["series"]: r["sum_other_vars"] for r in with_other_sum(df, df.where("series <> 'd'")).collect()}
    assert got["a"] == 3.5 and got["b"] == 1e17 + 0.5 and got["d"] == 1e17 + 3.5
    with_inf = {r["series"]: r["sum_other_vars"] for r in with_other_sum(df, df).collect()}
    assert with_inf["d"] == 1e17 + 3.5 and with_inf["a"] == float("inf")


def test_weighted_mean_of_a_long_series(spark):
    from almanack.operators.impute import with_ewm

    rows = spark.range(300_000).select(F.lit("a").alias("series"), F.col("id").alias("date"), F.lit(2.5).alias("value"))
    out = with_ewm(rows, 5).agg(F.min("ewm").alias("low"), F.max("ewm").alias("high")).first()
    assert math.isclose(out["low"], 2.5, rel_tol=1e-9) and math.isclose(out["high"], 2.5, rel_tol=1e-9)


def test_grid_covers_the_scaffold(spark):
    rows = [("a", date(2019, 1, 3), 1.0), ("a", date(2019, 1, 5), None), ("b", date(2018, 1, 1), 9.0),
            ("b", date(2019, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    grid = pn.dense_grid(df, date(2019, 1, 1), date(2019, 1, 6))
    assert values(grid) == [None, None, 1.0, None, None, None, 2.0, None, None, None, None, None]
    assert pn.missing_dates(df, date(2019, 1, 1), date(2019, 1, 6)).count() == 10


def test_fallback_only_where_nothing_is_known(spark, series_frame):
    base = series_frame({"base": [1, None, None, None]})
    first = series_frame({"first": [10, None, 30]})
    second = series_frame({"second": [100, 200, 300, 400, 500]})
    got = coalesce_sources(base, [first, second], ["date"], date(2019, 1, 1), date(2019, 1, 4))
    kept = sorted((r["series"], r["date"].day, r["value"]) for r in got.collect())
    assert kept == [
        ("base", 1, 1.0), ("base", 2, None), ("base", 3, None), ("base", 4, None),
        ("first", 2, None), ("first", 3, 30.0), ("second", 2, 200.0), ("second", 4, 400.0),
    ]


def test_one_row_per_day_is_enforced(spark):
    good = spark.createDataFrame([(date(2020, 1, 1), 1.0), (date(2020, 1, 2), None)], "date date, a double")
    assert pn.one_per_day(good).orderBy("date").collect() == good.orderBy("date").collect()
    with pytest.raises(Exception, match="two rows for one date"):
        pn.one_per_day(good.unionByName(good)).collect()


def test_pivot_rejects_two_values(spark, series_frame):
    df = series_frame({"a": [1]}).unionByName(series_frame({"a": [2]}))
    with pytest.raises(Exception, match="two values for one cell"):
        pn.pivot_wide(df, ["date"], "series", "value", ["a"]).collect()


# -- imputation -------------------------------------------------------------


@pytest.mark.parametrize("span", [2, 5, 7, 30])
def test_weighted_mean_equals_the_recursion(spark, series_frame, span):
    import numpy as np

    rng = np.random.default_rng(3)
    data = {}
    for name, n, missing in [("full", 900, 0), ("third", 1500, 0.35), ("sparse", 3000, 0.98), ("one", 40, 0.97)]:
        v = rng.gamma(2, 100, n).round(2)
        hide = rng.random(n) < missing
        hide[7] = False
        data[name] = [None if h else float(x) for x, h in zip(v, hide)]
    data["leading"] = [None] * 400 + data["third"][:300]
    data["nothing"] = [None] * 20
    got = im.with_ewm(series_frame(data), span).toPandas().sort_values(["series", "date"])
    for name, v in data.items():
        expected = pd.Series(v, dtype=float).ewm(span=span, adjust=False).mean()
        mine = got[got.series == name]["ewm"].to_numpy(dtype=float)
        np.testing.assert_allclose(mine, expected.to_numpy(), rtol=1e-11)


def test_nearest_years_mean(spark):
    rows = [("a", date(y, 3, 1), v) for y, v in [(2010, 1.0), (2011, None), (2012, 3.0), (2013, 100.0)]]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    assert values(im.with_nearest_years(df, 3), "doy_mean") == [None, 2.0, None, None]
    assert values(im.with_nearest_years(df, 2), "doy_mean")[1] == 1.0  # the earlier of two equals


def test_leap_day_has_few_donors(spark):
    rows = [("a", date(y, 2, 29), v) for y, v in [(2012, 4.0), (2016, None), (2020, 8.0)]]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    assert values(im.with_nearest_years(df, 12), "doy_mean")[1] == 6.0


def test_three_steps_and_markers(spark, series_frame):
    leading = [None] * 400 + [5.0, None, 7.0] + [1.0] * 10
    got = im.impute(series_frame({"a": leading, "empty": [None] * 5}), 7).orderBy("series", "date").collect()
    a = [r for r in got if r["series"] == "a"]
    assert a[401]["impute_method"] == "ewm" and a[401]["value"] == 5.0
    assert {r["impute_method"] for r in a[:400]} == {"doy", "bfill"}
    assert all(r["value"] is not None for r in a)
    assert sum(r["impute_method"] != "observed" for r in a) == 401
    assert all(r["value"] is None and r["impute_method"] is None for r in got if r["series"] == "empty")


def test_split_imputation_does_not_look_ahead(spark, series_frame):
    early = [None, None, 3.0, None, 4.0]
    one = im.split_impute(series_frame({"a": early + [50.0, None]}), date(2019, 1, 6), 7)
    two = im.split_impute(series_frame({"a": early + [None, 999.0]}), date(2019, 1, 6), 7)
    assert values(one)[:5] == values(two)[:5]
    assert one.count() == 7


def test_split_imputation_equals_two_runs(spark, series_frame):
    import numpy as np

    rng = np.random.default_rng(5)
    v = [None if rng.random() < 0.4 else float(x) for x in rng.integers(0, 99, 1500)]
    grid = series_frame({"a": [None] * 420 + v, "b": v + [None] * 30, "c": [None] * 900 + v[:700]})
    cut = date(2021, 2, 3)
    one = im.split_impute(grid, cut, 7, 2)
    two = im.impute(grid.where(F.col("date") < F.lit(cut)), 7, 2).unionByName(
        im.impute(grid, 7, 2).where(F.col("date") >= F.lit(cut))
    )

    def rounded(df):
        return df.withColumn("value", F.round("value", 6))

    assert rounded(one).exceptAll(rounded(two)).isEmpty() and one.count() == two.count()


def test_directions_are_imputed_around_the_circle(spark, series_frame):
    got = values(im.impute_directions(series_frame({"w": [350.0, 10.0, None]}), 1.0000001))
    assert math.isclose((got[2] - 10 + 180) % 360, 180, abs_tol=1e-3)
    straight = values(im.impute_directions(series_frame({"w": [350.0, 10.0, None]}), 3))
    assert math.isclose((straight[2] + 180) % 360, 180, abs_tol=1e-6)


# -- along a series ---------------------------------------------------------


def test_runs_wrap_and_break(spark, series_frame):
    flags = [1] * 1001 + [0] + [1, 1, None, 1]
    df = wn.with_run_lengths(series_frame({"a": flags}), {"run": F.col("value") >= 1})
    got = values(df, "run")
    assert got[998:1001] == [999, 0, 1]
    assert got[1001:] == [0, 1, 2, 0, 1]


@pytest.mark.parametrize("n", [7, 8, 13, 14, 15, 100])
def test_top_septile_is_the_quantile_cut(spark, series_frame, n):
    v = [float((i * 37) % 101) for i in range(n)]
    got = peak_thresholds(series_frame({"a": v + [None]})).first()["threshold"]
    bins = pd.qcut(pd.Series(v).rank(method="first"), 7, labels=False) + 1
    assert got == round(min(x for x, b in zip(v, bins) if b == 7), 0)


def test_peak_rule(spark, series_frame):
    thresholds = spark.createDataFrame([("a", 10.0), ("z", 0.0)], "series string, threshold double")
    df = series_frame({"a": [5, 20, 60, 200, 0, 30, None, 40, 50], "z": [5, 0, 0, 5]})
    got = flag_peaks(df, thresholds)
    assert values(got.where("series = 'a'"), "peak") == [0, 1, 0, 0, 0, 1, 0, 0, 0]
    assert values(got.where("series = 'z'"), "peak") == [0, 0, 0, 1]


def test_season_needs_a_total(spark, series_frame):
    df = series_frame({"zero": [0] * 10, "none": [None] * 10, "a": [1] * 100, "gap": [None, 50, None, 50]})
    got = {r["series"]: (r["season_start"], r["season_end"]) for r in seasons.season_dates(df).collect()}
    # in doubles 100 * (1 - (1 - 0.9) / 2) is exactly 95
    assert got == {"a": (5, 95), "gap": (2, 4)}
    assert "zero" not in got and "none" not in got


def test_other_sum_when_nobody_reports(spark, series_frame):
    df = series_frame({"a": [1, 2], "b": [None, 10], "total": [7, 7]})
    got = {(r["series"], r["date"].day): r["sum_other_vars"] for r in with_other_sum(df, df, "total").collect()}
    assert got[("a", 1)] == 0.0 and got[("a", 2)] == 10.0
    assert got[("b", 1)] == 1.0 and got[("total", 2)] == 12.0


# -- stations ---------------------------------------------------------------


def test_nearest_keeps_ties_and_nulls_last(spark):
    rows = [("v", 1, 2.0, "p"), ("v", 1, 2.0, "q"), ("v", 1, 3.0, "r"), ("w", 1, None, "s")]
    df = spark.createDataFrame(rows, "variable string, date int, dist double, site string")
    assert sorted(r["site"] for r in st.nearest_station(df, "dist").collect()) == ["p", "q", "s"]


def test_samplers_must_not_overlap():
    from almanack.operators.stations import samplers_join

    spans = [("d", "2000-01-01", "2001-12-31", None, "a"), ("d", "2001-12-31", "2003-01-01", None, "b")]
    with pytest.raises(ValueError):
        samplers_join(None, None, None, None, None, spans)


def test_flags_and_strict_means(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", None), ("b", 0.0), ("b", None), ("c", 2.0), ("c", 0.0)], "k string, value double"
    )
    got = {r["k"]: (r["f"], r["m"]) for r in df.groupBy("k").agg(
        st.any_flag(F.col("value")).alias("f"), st.strict_mean(F.col("value")).alias("m")).collect()}
    assert got == {"a": (None, None), "b": (0, None), "c": (1, 1.0)}


def test_coverage_prefers_the_inner_ring(spark):
    rows = [(2000, "intra", s) for s in "ab"] + [(2001, "intra", "a"), (2001, "extra", "x"), (2002, "extra", "x")]
    got = st.ring_coverage(spark.createDataFrame(rows, "year int, ring string, site string"))
    assert {r["year"]: (r["intra"], r["extra"], r["ring"]) for r in got.collect()} == {
        2000: (2, None, "intra"), 2001: (1, 1, "extra"), 2002: (None, 1, "extra"),
    }


def test_effect_ranks_without_base_and_with_ties(spark):
    rows = [("s", "x", c, v) for c, v in [(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)]]
    rows += [("t", "x", c, v) for c, v in [(3, 2.0), (9, 8.0)]]
    df = spark.createDataFrame(rows, "site string, series string, class int, value double")
    got = {(r["site"], r["class"]): (r["effect"], r["cor_rank"]) for r in class_effect_rank(df).collect()}
    assert got[("s", 1)] == (5.0, 1.0) and got[("s", 2)] == (2.0, 2.5) == got[("s", 3)]
    assert got[("s", 4)] == (-4.0, 4.0) and got[("t", 3)] == (2.0, 2.0) and got[("t", 9)] == (6.0, 1.0)
