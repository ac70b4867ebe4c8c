"""What the plans promise: pushdown, few shuffles, nothing quadratic."""

import pytest
from pyspark.sql import functions as F

from almanack.registry import QUERIES


def plan_of(df):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def plans(spark, folder):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = plan_of(QUERIES[name](spark, folder))
        return cache[name]

    return get


def test_filters_and_columns_reach_the_scan(plans):
    text = plans("scan_filter")
    assert "GreaterThan(l_quantity,27.0)" in text and "GreaterThan(l_discount,0.01)" in text
    assert "l_extendedprice" not in text.split("ReadSchema")[1].split("\n")[0]


def test_five_way_join_is_narrowed(plans):
    text = plans("station_full_join")
    assert "FullOuter" not in text
    assert "Inner" in text and "LeftOuter" in text


def test_nearest_station_prunes_before_the_shuffle(plans):
    text = plans("nearest_station")
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "shadow_selection", "shadow_selection_counts", "peak_model", "count_model", "model_store",
    "hyperparameter_store", "tuned_peak_model", "search_folds"}))
def test_no_pairwise_joins(plans, name):
    text = plans(name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text or name in SINGLE


# one-row aggregates end in one task by nature; their input is combined before
SINGLE = {
    "null_report", "inf_report", "label_metrics", "shadow_permutation", "null_columns_of_features",
}


def test_windows_of_the_feature_panel_share_one_shuffle(plans):
    text = plans("feature_panel")
    by_series = text.count("Arguments: hashpartitioning(series")
    assert by_series < 12


def test_imputation_is_one_shuffle(spark, series_frame):
    from almanack.operators.impute import impute

    text = plan_of(impute(series_frame({"a": [1, None, 3]}), 7))
    assert text.count("Arguments: hashpartitioning") == 1


def test_panels_see_no_date_after_the_split_in_training(spark, folder):
    from almanack.registry.history import panel_of_features
    from almanack.registry import fixtures as fx

    df = panel_of_features(spark, folder)
    assert df.where(F.col("peak").isNull()).count() == 0
    adjacent = df.select("series", F.date_add("date", 1).alias("date"), "peak").where("peak = 1")
    both = df.where("peak = 1").join(adjacent.select("series", "date"), ["series", "date"], "left_semi")
    assert both.count() == 0
    kept = df.where(F.col("date") < F.lit(fx.SPLIT)).select("series", "year").distinct()
    assert kept.count() <= 5 * 4
