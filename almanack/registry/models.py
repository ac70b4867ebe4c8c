"""Splits, sampling, encoding, selection, fits and their scores."""

import hashlib
import json

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from almanack.operators import bagging, encode, metrics, selection, walkforward
from almanack.operators.panel import drop_by_prefix, split_at
from almanack.operators.peaks import flag_peaks, peak_thresholds
from almanack.operators.windows import with_lags
from almanack.plans import forecast
from almanack.registry import fixtures as fx
from almanack.registry.base import register, with_
from almanack.registry.history import FEATURE_PANEL, last_steps, panel_of_features
from almanack.registry.preparation import PEAKS_OF_OBS, THRESHOLD_OF_OBS
from almanack.sources import runs, sinks

# -- splits and samples -----------------------------------------------------


@register("split_table", with_(fx.OBS_NATION) + """
  SELECT series, start_year, skipped, fold, tl AS train_rows, tl AS test_lo, tl + test AS test_hi FROM (
    SELECT *, rest - (folds - fold + 1) * test AS tl FROM (
      SELECT *, rest // (folds + 1) AS test, CAST(unnest(generate_series(1, folds)) AS INTEGER) AS fold FROM (
        SELECT series, CAST(y AS INTEGER) AS start_year, CAST(before AS BIGINT) AS skipped,
               CAST(every - before AS BIGINT) AS rest, ix // step + 2 AS folds
        FROM (SELECT *, years // least(9, years) AS step FROM (
          SELECT series, y, rows, row_number() OVER (PARTITION BY series ORDER BY y) - 1 AS ix,
                 count(*) OVER (PARTITION BY series) AS years, sum(rows) OVER (PARTITION BY series) AS every,
                 sum(rows) OVER (PARTITION BY series ORDER BY y) - rows AS before
          FROM (SELECT series, year(date) AS y, count(*) AS rows FROM obs GROUP BY 1, 2)))
        WHERE ix % step = 0 AND ix // step < least(9, years))))""")
def split_table(spark, folder):
    return walkforward.split_table(fx.obs_nation(spark, folder))


def peaks_of(spark, folder):
    panel = fx.obs(spark, folder)
    return flag_peaks(panel, peak_thresholds(panel))


@register("undersample", with_(fx.OBS, THRESHOLD_OF_OBS, PEAKS_OF_OBS, """counted AS (
    SELECT *, count(*) FILTER (WHERE peak = 1) OVER (PARTITION BY series) AS pos,
           count(*) FILTER (WHERE peak = 0) OVER (PARTITION BY series) AS neg FROM peaks)""") + """
  SELECT series, date, value, peak FROM counted
  WHERE peak = 1 OR CAST('0x' || substr(md5(series || '|' || CAST(date AS VARCHAR) || '|0'), 1, 8) AS BIGINT)
    / 4294967296.0 < pos / nullif(CAST(0.5 AS DOUBLE) * neg, 0)""")
def undersample(spark, folder):
    return bagging.undersample(
        peaks_of(spark, folder), "peak", ["series", "date"], 0, ratio=0.5, group=["series"]
    )


@register("metrics", with_(fx.OBS, THRESHOLD_OF_OBS, PEAKS_OF_OBS, """guessed AS (
    SELECT series, peak AS truth, CASE WHEN value >= threshold THEN 1 ELSE 0 END AS prediction FROM peaks),
  counted AS (
    SELECT series, count(*) FILTER (WHERE prediction = 1 AND truth = 1) AS tp,
           count(*) FILTER (WHERE prediction = 1 AND truth <> 1) AS fp,
           count(*) FILTER (WHERE prediction <> 1 AND truth = 1) AS fn,
           count(*) FILTER (WHERE prediction <> 1 AND truth <> 1) AS tn FROM guessed GROUP BY series)""") + """
  SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS sensitivity,
         tn / nullif(tn + fp, 0) AS specificity,
         sqrt(tp / nullif(tp + fn, 0) * (tn / nullif(tn + fp, 0))) AS geometric_mean FROM counted""")
def metrics_query(spark, folder):
    panel = fx.obs(spark, folder)
    thresholds = peak_thresholds(panel)
    guessed = flag_peaks(panel, thresholds).join(thresholds, "series", "left").select(
        "series", F.col("peak").alias("truth"),
        F.when(F.col("value") >= F.col("threshold"), 1).otherwise(0).alias("prediction"),
    )
    return metrics.classification_metrics(guessed, keys=["series"])


@register("label_metrics", """
  WITH counted AS (
    SELECT count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS tp, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp,
           count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS fn, count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tn
    FROM labels)
  SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS sensitivity,
         tn / nullif(tn + fp, 0) AS specificity,
         sqrt(tp / nullif(tp + fn, 0) * (tn / nullif(tn + fp, 0))) AS geometric_mean FROM counted""")
def label_metrics(spark, folder):
    guessed = fx.table(spark, folder, "labels").select(
        F.col("quality").alias("truth"), (1 - F.col("toxic")).alias("prediction")
    )
    return metrics.classification_metrics(guessed)


@register("attach_predictions", with_(fx.OBS, THRESHOLD_OF_OBS, PEAKS_OF_OBS) + f"""
  SELECT series, date, value, CASE WHEN date < DATE '{fx.SPLIT}' THEN peak
         WHEN value >= threshold THEN 1 ELSE 0 END AS peak FROM peaks""")
def attach_predictions(spark, folder):
    panel = fx.obs(spark, folder)
    thresholds = peak_thresholds(panel)
    frame = flag_peaks(panel, thresholds)
    high = F.when(F.col("value") >= F.col("threshold"), 1).otherwise(0)
    predicted = panel.join(thresholds, "series", "left").select("series", "date", high.alias("prediction"))
    return forecast.attach_peaks(frame, predicted, fx.SPLIT)


# -- matrices ---------------------------------------------------------------


@register("standardise", with_(fx.OBS, f"""lagged AS (
    SELECT *, lag(value) OVER (PARTITION BY series ORDER BY date) AS value_lag1 FROM obs),
  fitted AS (SELECT avg(value) AS m, stddev_pop(value) AS s, avg(value_lag1) AS m1, stddev_pop(value_lag1) AS s1
             FROM lagged WHERE date < DATE '{fx.SPLIT}')""") + """
  SELECT series, date, round((value - m) / s, 6) AS value, round((value_lag1 - m1) / s1, 6) AS value_lag1
  FROM lagged, fitted""")
def standardise(spark, folder):
    df = with_lags(fx.obs(spark, folder), ["value"], 1)
    columns = ["value", "value_lag1"]
    fitted = encode.fit_scaler(split_at(df, "date", fx.SPLIT)[0], columns)
    return encode.scale(df, fitted).withColumns({c: F.round(c, 6) for c in columns})


_STATUS = ["F", "O", "P"]


@register("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CAST(o_orderstatus = '{s}' AS DOUBLE) AS \"status_is_{s}\"" for s in _STATUS) + " FROM orders")
def one_hot(spark, folder):
    orders = fx.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    model = Pipeline(stages=encode.one_hot_stages(["status"])).fit(orders)
    levels = model.stages[0].labelsArray[0]
    slots = vector_to_array("status_is")
    return model.transform(orders).select(
        "o_orderkey", *[slots[i].alias(f"status_is_{level}") for i, level in enumerate(levels)]
    )


@register("matrix_restrict", """
  SELECT o_orderkey, CAST(o_orderstatus = 'O' AS DOUBLE) AS "status_is_O",
         round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
               / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS price FROM orders""")
def matrix_restrict(spark, folder):
    orders = fx.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
    )
    matrix, names = encode.fit_matrix(orders, ["status"], ["price"])
    kept = [n for n in names if n in ("status_is_O", "price")]
    picked = vector_to_array("selected")
    return encode.restrict(matrix(orders), kept).select(
        "o_orderkey", *[F.round(picked[i], 6).alias(n) for i, n in enumerate(kept)]
    )


@register("shadow_permutation", """
  SELECT round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
         round(sum(l_quantity), 2) AS shadow_l_quantity, round(sum(l_extendedprice), 2) AS shadow_l_extendedprice,
         true AS moved
  FROM lineitem""")
def shadow_permutation(spark, folder):
    """Sums per column and per permuted copy agree, as nothing is lost; ``moved`` says
    that at least nine in ten prices are not their row's own."""
    items = fx.table(spark, folder, "lineitem")
    columns = ["l_quantity", "l_extendedprice"]
    keyed = items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *columns)
    shuffled = selection.with_shadows(
        keyed, columns, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 1
    )
    names = [*columns, *[f"shadow_{c}" for c in columns]]
    strange = F.count_if(F.col("shadow_l_extendedprice") != F.col("l_extendedprice"))
    moved = (strange * 10 >= F.count(F.lit(1)) * 9).alias("moved")
    return shuffled.agg(*[F.round(F.sum(n), 2).alias(n) for n in names], moved)


# -- fits -------------------------------------------------------------------


def stage(spark, folder, name, make):
    """A stage's table: of the newest run over this input in the session, else of a new one.

    Stages feed each other through what they store, so the panel, a selection or the
    predicted peaks are worked out once a session.
    """
    root = f"{sinks.shared_folder(spark)}/stages-{spark.sparkContext.applicationId}/{hashlib.md5(folder.encode()).hexdigest()}/{name}"
    sinks.owned_by_session(spark, root)
    place = runs.newest_or_new(spark, root, lambda where: make().write.parquet(where))
    return spark.read.parquet(place)


def modelling_rows(spark, folder):
    """Every series' rows of the panel."""
    return stage(spark, folder, "rows", lambda: forecast.modelling_frame(panel_of_features(spark, folder)))


def selection_for_peaks(spark, folder):
    rows = modelling_rows(spark, folder)
    return stage(spark, folder, "peak-slots", lambda: forecast.selected_slots(rows, fx.SPLIT, "peak"))


def fed_rows(spark, folder):
    """The rows of the count stage: from the split on peaks are predicted ones."""
    return forecast.attach_peaks(modelling_rows(spark, folder), predicted_peaks(spark, folder), fx.SPLIT)


def selection_for_counts(spark, folder):
    return stage(spark, folder, "count-slots", lambda: forecast.selected_slots(fed_rows(spark, folder), fx.SPLIT, "count"))


def peak_stage(spark, folder):
    """The peak stage of every series on its confirmed slots, on all where none is confirmed."""
    binned = forecast.Binned(modelling_rows(spark, folder), fx.SPLIT)
    slots = selection.confirmed_slots(selection_for_peaks(spark, folder))
    return binned, *forecast.peaks_of_all(binned, slots)


def predicted_peaks(spark, folder):
    return stage(spark, folder, "peaks", lambda: peak_stage(spark, folder)[1])


def count_stage(spark, folder):
    """The count stage, which the predicted peaks feed, on each series' confirmed slots."""
    binned = forecast.Binned(fed_rows(spark, folder), fx.SPLIT, ["peak"])
    slots = selection.confirmed_slots(selection_for_counts(spark, folder))
    return binned, *forecast.counts_of_all(binned, slots)


@register("null_columns_of_features", f"""
  SELECT count(*) - count(COLUMNS('(.*)')) AS "\\1" FROM ({FEATURE_PANEL} {last_steps()})""")
def null_columns_of_features(spark, folder):
    from almanack.operators.panel import null_counts

    frame = panel_of_features(spark, folder)
    return null_counts(frame, frame.columns)


@register("shadow_selection")
def shadow_selection(spark, folder):
    """The encoded features of every series against shuffled copies, for peaks."""
    return selection_for_peaks(spark, folder)


@register("shadow_selection_counts")
def shadow_selection_counts(spark, folder):
    return selection_for_counts(spark, folder)


@register("peak_model")
def peak_model(spark, folder):
    return predicted_peaks(spark, folder)


@register("count_model")
def count_model(spark, folder):
    return count_stage(spark, folder)[1]


@register("model_store", f"""
  SELECT series, date, peak, outcome, true AS same_peak, true AS same_count
  FROM ({FEATURE_PANEL} {last_steps()}) WHERE date >= DATE '{fx.SPLIT}'""")
def model_store(spark, folder):
    """Both stages of all series stored as one run and read back: every day from the
    split on is predicted, as by the models that were stored."""
    first, peaks, stumps = peak_stage(spark, folder)
    second, counts, trees = count_stage(spark, folder)
    root = sinks.staging_path(spark, "models")
    sinks.owned_by_session(spark, root)

    def write(place):
        forecast.save_stage(first, "peaks", stumps, f"{place}/peaks")
        forecast.save_stage(second, "counts", trees, f"{place}/counts")

    place = runs.newest_or_new(spark, root, write)
    late = lambda df: df.where(F.col("date") >= F.lit(fx.SPLIT))
    key = ["series", "date"]
    rows, fed = modelling_rows(spark, folder), fed_rows(spark, folder)
    again = forecast.StoredStage(spark, f"{place}/peaks").peaks(late(rows)).select(*key, F.col("prediction").alias("_p"))
    counted = forecast.StoredStage(spark, f"{place}/counts").counts(late(fed)).select(*key, F.col("prediction").alias("_c"))
    out = peaks.withColumnRenamed("prediction", "_was").join(again, key, "left")
    out = out.join(counts.select(*key, "prediction"), key, "left").join(counted, key, "left")
    return out.select(
        *key, "peak", "outcome", F.coalesce(F.col("_was") == F.col("_p"), F.lit(False)).alias("same_peak"),
        F.coalesce(F.col("prediction") == F.col("_c"), F.lit(False)).alias("same_count"),
    )


GRID = {"bags": [10], "ratio": [0.5, 1.0], "rounds": [25, 50]}


def stored_search(spark, folder):
    """The place of the newest search of all series forward in time: tables of folds, of
    settings and of the best settings."""
    root = f"{sinks.shared_folder(spark)}/searches-{spark.sparkContext.applicationId}/{hashlib.md5(folder.encode()).hexdigest()}"
    sinks.owned_by_session(spark, root)

    def write(place):
        binned = forecast.Binned(modelling_rows(spark, folder), fx.SPLIT, years=True)
        folds, table, best = forecast.search_of_all(binned, GRID)
        folds.write.parquet(f"{place}/folds")
        table.withColumn("date_run", F.current_timestamp()).write.parquet(f"{place}/table")
        best.write.parquet(f"{place}/best")

    return runs.newest_or_new(spark, root, write)


@register("hyperparameter_store")
def hyperparameter_store(spark, folder):
    """The table of the newest stored search, with scores on training rows beside those on
    test rows."""
    return spark.read.parquet(f"{stored_search(spark, folder)}/table").drop("date_run")


@register("search_folds", with_(f"""rows AS (
    SELECT series, date FROM ({FEATURE_PANEL} {last_steps()}) WHERE date < DATE '{fx.SPLIT}' AND peak IS NOT NULL)""", """starts AS (
    SELECT series, y, ix // step + 2 AS folds FROM (
      SELECT *, years // least(9, years) AS step FROM (
        SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY y) - 1 AS ix, count(*) OVER (PARTITION BY series) AS years
        FROM (SELECT DISTINCT series, year(date) AS y FROM rows)))
    WHERE ix % step = 0 AND ix // step < least(9, years))""") + f"""
  SELECT series, CAST(y AS INTEGER) AS start_year, CAST(unnest(generate_series(1, folds)) AS INTEGER) AS fold,
         CAST({len(GRID["bags"]) * len(GRID["ratio"]) * len(GRID["rounds"])} AS BIGINT) AS settings, true AS scored FROM starts""")
def search_folds(spark, folder):
    """Every start, fold and setting of the search is scored, in training and in test."""
    folds = spark.read.parquet(f"{stored_search(spark, folder)}/folds")
    seen = F.col("train_specificity").isNotNull() & F.col("test_specificity").isNotNull()
    return folds.groupBy("series", "start_year", "fold").agg(F.count_distinct("params").alias("settings"), F.bool_and(seen).alias("scored"))


@register("tuned_peak_model")
def tuned_peak_model(spark, folder):
    """Peaks predicted with each series' best settings of the newest stored search, on its
    confirmed slots."""
    rows = modelling_rows(spark, folder)
    stored = spark.read.parquet(f"{stored_search(spark, folder)}/best")
    chosen = runs.chosen_parameters(rows, json.dumps(forecast.PEAK_DEFAULTS), stored)
    params = {r["series"]: json.loads(r["params"]) for r in chosen.collect()}
    slots = selection.confirmed_slots(selection_for_peaks(spark, folder))
    scored, _ = forecast.peaks_of_all(forecast.Binned(rows, fx.SPLIT), slots, params)
    return scored.join(chosen, "series")


@register("run_stamps", """
  SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y_%H%M') AS stamp FROM orders""")
def run_stamps(spark, folder):
    return fx.table(spark, folder, "orders").select("o_orderkey", runs.run_stamp("o_orderdate").alias("stamp"))


@register("parameter_choice", with_(fx.OBS, """latest AS (
    SELECT series, CAST(year(max(date)) AS VARCHAR) AS params FROM obs GROUP BY 1)""") + """
  SELECT series, CASE WHEN series LIKE '%LOW' THEN 'tuned' WHEN series LIKE '%URGENT' THEN 'default' ELSE params END AS params,
         CASE WHEN series LIKE '%LOW' THEN 'tuned' WHEN series LIKE '%URGENT' THEN 'default' ELSE 'stored' END AS origin
  FROM latest""")
def parameter_choice(spark, folder):
    """Of an older run, the newest one and one that broke off, the newest gives the
    settings of series that were not just tuned; a series it does not know has the default."""
    panel = fx.obs(spark, folder)
    root = sinks.staging_path(spark, "choice")
    sinks.owned_by_session(spark, root)
    known = panel.where(~F.col("series").endswith("URGENT")).groupBy("series")
    year = lambda f: F.year(f("date")).cast("string").alias("params")
    runs.store_run(spark, root, "02012024_0900", known.agg(year(F.max)).write.parquet)
    runs.store_run(spark, root, "31122023_2359", known.agg(year(F.min)).write.parquet)
    known.agg(F.lit("half").alias("params")).write.parquet(f"{root}/data/broken")
    stored = spark.read.parquet(runs.newest_run(spark, root))
    tuned = panel.where(F.col("series").endswith("LOW")).select("series", F.lit("tuned").alias("params")).distinct()
    return runs.chosen_parameters(panel, "default", stored, tuned)


_RESULTS = (
    "series string, start_year int, params string, mean_test_precision double, mean_test_sensitivity double, "
    "mean_test_specificity double, mean_test_geometric_mean double"
)


@register("series_columns_dropped", f"""
  SELECT * EXCLUDE (sum_other_vars, sum_other_vars_lag1, sum_other_vars_lag2, sum_other_vars_lag3)
  FROM ({FEATURE_PANEL} {last_steps()})""")
def series_columns_dropped(spark, folder):
    """The panel without the other series' columns."""
    frame = panel_of_features(spark, folder, other_counts=fx.SERIES)
    return drop_by_prefix(frame, [*fx.SERIES, "sum_other_vars"])
