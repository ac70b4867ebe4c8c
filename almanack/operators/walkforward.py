"""Forward-walking validation: later starts, expanding folds."""

import json
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.sql import Window, functions as F

from almanack.operators.metrics import classification_metrics
from almanack.operators.panel import by_date
from almanack.settings import MAX_STARTS
from almanack.sources.sinks import staged


def split_table(df, max_starts=MAX_STARTS):
    """``(series, start_year, skipped, fold, train_rows, test_lo, test_hi)``.

    Years in order give at most ``max_starts`` evenly spaced start years; from the
    i-th start the rows are cut into i + 2 test blocks of equal size at the end,
    each trained on everything before it.  Row numbers count from the start year;
    ``skipped`` is the number of rows before it.  Works on counts per year.
    """
    years = df.groupBy("series", F.year("date").alias("start_year")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy("series")
    order = whole.orderBy("start_year")
    counted = (
        years.withColumns(
            {
                "_at": F.row_number().over(order) - 1,
                "_years": F.count(F.lit(1)).over(whole),
                "_all": F.sum("_rows").over(whole),
                "_seen": F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            }
        )
        .withColumn("skipped", F.col("_seen") - F.col("_rows"))
        .withColumn("_left", F.col("_all") - F.col("skipped"))
        .withColumn("_step", F.expr(f"_years div least({max_starts}, _years)"))
        .where(f"_at % _step = 0 AND _at div _step < least({max_starts}, _years)")
        .withColumn("_folds", F.expr("_at div _step + 2"))
        .withColumn("_test", F.expr("_left div (_folds + 1)"))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.col("_folds").cast("int"))))
    )
    test_lo = F.col("_left") - (F.col("_folds") - F.col("fold") + 1) * F.col("_test")
    return counted.select(
        "series", "start_year", "skipped", "fold",
        test_lo.alias("train_rows"), test_lo.alias("test_lo"),
        (test_lo + F.col("_test")).alias("test_hi"),
    )


SCORES = ("precision", "sensitivity", "specificity", "geometric_mean")


def fold_rows(numbered, splits):
    """The rows of every fold: ``numbered`` has ``_row`` per series, ``splits`` an
    ``ensemble`` number beside the columns of ``split_table``; adds ``ensemble`` and
    ``part``, train or test."""
    at = F.col("_row") - F.col("skipped")
    joined = numbered.join(splits, "series").where((at >= 0) & (at < F.col("test_hi")))
    part = F.when(at < F.col("test_lo"), "train").otherwise("test")
    return joined.withColumn("part", part).drop("_row", "skipped", "train_rows", "test_lo", "test_hi")


def fold_table(metrics, labels):
    """``(series, params, start_year, fold, test_…, train_…)`` from the scores of each
    ``ensemble`` and ``part`` and the ensembles' ``labels``."""
    wide = labels
    for part in ("test", "train"):
        own = metrics.where(F.col("part") == part)
        wide = wide.join(own.select("ensemble", *[F.col(m).alias(f"{part}_{m}") for m in SCORES]), "ensemble", "left")
    return wide.drop("ensemble")


def search_table(folds, rank_by="precision"):
    """Means over folds, a score without a denominator counting 0, best first."""
    means = [F.avg(F.coalesce(F.col(f"{p}_{m}"), F.lit(0.0))).alias(f"mean_{p}_{m}") for p in ("test", "train") for m in SCORES]
    table = folds.groupBy("series", "start_year", "params").agg(*means, F.count(F.lit(1)).alias("folds"))
    return table.orderBy("series", F.desc(f"mean_test_{rank_by}"), "start_year", "params")


def best_parameters(table, rank_by="precision"):
    """``(series, params)``: the first best mean of all starts and settings."""
    order = Window.partitionBy("series").orderBy(F.desc(f"mean_test_{rank_by}"), "start_year", "params")
    return table.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("series", "params")


def forward_walk_search(df, grid, fit, predict, truth, max_starts=MAX_STARTS,
                        rank_by="precision", parallelism=4):
    """Score a grid over every series, start and fold: ``(results, {series: best})``.

    ``fit(train, **params)`` and ``predict(model, test)`` run on Spark.  The driver
    only holds the split table and one score per fit; fits run concurrently, as in
    Spark's own cross validator.  The first best mean wins.
    """
    spark = df.sparkSession
    # written once: every fold and grid point reads the numbered rows
    rows = staged(df.withColumn("_row", F.row_number().over(by_date()) - 1), "numbered")
    splits = [
        r.asDict() for r in split_table(df, max_starts).orderBy("series", "start_year", "fold").collect()
    ]
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]

    def score(job):
        split, params = job
        base, cut = split["skipped"], split["skipped"] + split["train_rows"]
        own = rows.where(F.col("series").eqNullSafe(F.lit(split["series"])))
        train = own.where((F.col("_row") >= base) & (F.col("_row") < cut))
        test = own.where(
            (F.col("_row") >= base + split["test_lo"]) & (F.col("_row") < base + split["test_hi"])
        )
        scored = predict(fit(train, **params), test)
        result = classification_metrics(scored, "prediction", truth).first().asDict()
        return {
            "series": split["series"], "params": json.dumps(params), "start_year": split["start_year"], "fold": split["fold"],
            **{m: result[m] for m in ("precision", "sensitivity", "specificity", "geometric_mean")},
        }

    with ThreadPool(parallelism) as pool:
        scores = pool.map(score, [(s, p) for s in splits for p in settings])
    folds = spark.createDataFrame(
        scores,
        "series string, params string, start_year int, fold int, precision double, sensitivity double, "
        "specificity double, geometric_mean double",
    )
    results = (
        folds.groupBy("series", "start_year", "params")
        .agg(
            *[
                F.avg(F.coalesce(F.col(m), F.lit(0.0))).alias(f"mean_test_{m}")
                for m in ("precision", "sensitivity", "specificity", "geometric_mean")
            ]
        )
        .withColumn("date_run", F.current_timestamp())
        .orderBy("series", F.desc(f"mean_test_{rank_by}"))
    )
    best = results.withColumn(
        "_r",
        F.row_number().over(
            Window.partitionBy("series").orderBy(F.desc(f"mean_test_{rank_by}"), "start_year", "params")
        ),
    ).where("_r = 1")
    return results, {r["series"]: json.loads(r["params"]) for r in best.collect()}
