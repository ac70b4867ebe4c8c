"""Two stages: will the day be a peak, then how high is the count."""

import json
from itertools import product

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from almanack import settings as S
from almanack.operators.bagging import bag_members, fit_bags, predict_bags
from almanack.operators.boosted import (
    STORED, Stumps, bag_votes, boost, boosted_values, fit_stumps, trees_of, trees_table,
)
from almanack.operators.encode import Matrix, fit_matrix, restrict
from almanack.operators.manytrees import Draw, Rule, bin_cuts, with_bins
from almanack.operators.metrics import classification_metrics
from almanack.operators.panel import by_date, drop_by_prefix, split_at
from almanack.operators.selection import slot_selection
from almanack.operators.walkforward import best_parameters, fold_rows, fold_table, forward_walk_search, search_table, split_table
from almanack.sources.runs import load_latest, save_best
from almanack.sources.sinks import staged

KEY = ["series", "date"]


def modelling_frame(panel, series=None, other_series=(), keep_other=True):
    """One series or all, without the columns that would leak or are not modelled."""
    df = panel if series is None else panel.where(F.col("series") == series)
    df = drop_by_prefix(df, ["outcome_lag", "date_lag"]).drop(*S.NOT_MODELLED_COLUMNS)
    if not keep_other:
        df = drop_by_prefix(df, [*other_series, "sum_other_vars"])
    return df


def column_kinds(df, extra_categorical=()):
    categorical = [c for c in [*extra_categorical, *S.CATEGORICAL] if c in df.columns]
    left_out = {*KEY, "outcome", "peak", *categorical}
    return categorical, [c for c in df.columns if c not in left_out]


def series_of(frame):
    """The names of the series, in order: one model, or one set of bags, each."""
    return [r["series"] for r in frame.select("series").distinct().orderBy("series").collect()]


class Binned:
    """All series' rows as bins, written once; fitted on the rows before ``cut``.

    A day with missing features stays: a missing slot has a bin of its own.  Slots are the
    same for all series; levels and cuts are each series' own where they matter.
    """

    def __init__(self, frame, cut, extra_categorical=(), years=False):
        self.cut, self.years = cut, years
        self.categorical, self.numeric = column_kinds(frame, extra_categorical)
        train = frame.where(F.col("date") < F.lit(cut))
        self.matrix, names = fit_matrix(train, self.categorical, self.numeric, invalid="keep")
        self.names = [*names, *(["year"] if years else [])]
        slots = staged(self.slotted(frame), "slots")
        self.cuts = staged(bin_cuts(slots.where(F.col("date") < F.lit(cut))), "cuts")
        self.series = series_of(slots)
        self.rows = staged(self.binned(slots), "bins")

    def slotted(self, frame):
        slots = vector_to_array("features")
        if self.years:
            slots = F.concat(slots, F.array(F.year("date").cast("double")))
        kept = [c for c in ("peak", "outcome") if c in frame.columns]
        return self.matrix(frame).select(*KEY, *kept, slots.alias("slots"))

    def binned(self, slots):
        number = F.array_position(F.array(*[F.lit(s) for s in self.series]), F.col("series")) - 1
        return with_bins(slots, self.cuts).drop("slots").withColumn("model", number.cast("int"))

    def early(self):
        return self.rows.where(F.col("date") < F.lit(self.cut))

    def late(self):
        return self.rows.where(F.col("date") >= F.lit(self.cut))

    def allowed(self, selected):
        """Places of each series' selected slots; a series without any may use all."""
        if not selected:
            return ()
        every = tuple(range(len(self.names)))
        own = [tuple(i for i in every if self.names[i] in set(selected.get(s, ()))) for s in self.series]
        return tuple(o or every for o in own)


PEAK_DEFAULTS = {"bags": 10, "ratio": 1.0, "rounds": 50}


def peaks_of_all(binned, selected=None, params=None, seed=42):
    """Balanced bags of reweighted stumps for every series, all fitted at once:
    ``(series, date, prediction, peak, outcome)`` from the cut on, and the stumps.

    ``params``: ``{series: settings}`` where they are not ``PEAK_DEFAULTS``.
    """
    own = [{**PEAK_DEFAULTS, **(params or {}).get(s, {})} for s in binned.series]
    most = max((o["bags"] for o in own), default=1)
    of_series = lambda name, kind: F.get(F.array(*[F.lit(kind(o[name])) for o in own]), F.col("model"))
    labelled = binned.early().where("peak IS NOT NULL")
    members = bag_members(labelled, "peak", KEY, ["series"], of_series("bags", int), of_series("ratio", float))
    allowed = tuple(a for a in binned.allowed(selected) for _ in range(most))
    draw = Draw(len(binned.names), seed=seed, allowed=allowed)
    bag = (F.col("model") * most + F.col("bag")).cast("int")
    members = members.select(bag.alias("model"), "bins", F.col("peak").alias("y"))
    stumps = fit_stumps(members, len(own) * most, draw, max((o["rounds"] for o in own), default=0))
    bags_of = [range(i * most, i * most + o["bags"]) for i, o in enumerate(own)]
    asked = binned.late().withColumn("ensemble", F.col("model"))
    voted = bag_votes(asked, stumps, bags_of, [o["rounds"] for o in own])
    return voted.select(*KEY, "prediction", "peak", "outcome"), stumps


def selected_slots(frame, cut, kind, rounds=20, level=0.05, depth=16):
    """``slot_selection`` of every series' encoded features on the rows before ``cut``
    that miss none, for the peak or the count."""
    label = "peak" if kind == "peak" else "outcome"
    categorical, numeric = column_kinds(frame, [] if kind == "peak" else ["peak"])
    train = split_at(frame.na.drop(subset=[*categorical, *numeric, label]), "date", cut)[0]
    matrix, names = fit_matrix(train, categorical, numeric)
    slots = vector_to_array("features").alias("slots")
    rows = staged(matrix(train).select(*KEY, slots, label), "slots")
    forest = selection_forest(kind, depth=depth, least=5)
    return slot_selection(rows, names, label, forest, KEY, rounds, level)


def counts_of_all(binned, selected=None, trees=100, depth=7, rate=0.04, rows=0.9, per_tree=0.2,
                  per_level=0.7, seed=42):
    """Boosted trees for every series' counts, all fitted at once, with a draw of slots per
    tree and a further one per level: ``(series, date, prediction, outcome)`` from the cut
    on, and ``(start values, trees)``."""
    draw = Draw(len(binned.names), per_tree, per_level, seed, binned.allowed(selected))
    train = binned.early().where("outcome IS NOT NULL").withColumn("y", F.col("outcome"))
    start, grown = boost(train, len(binned.series), KEY, draw, trees, rate, rows, Rule(depth, 1.0, 1.0))
    scored = boosted_values(binned.late(), start, grown, rate)
    return scored.select(*KEY, "prediction", "outcome"), (start, grown)


SEARCH_DEFAULTS = {"bags": [100], "ratio": [S.UNDERSAMPLE_RATIO], "rounds": [50]}


def search_of_all(binned, grid, max_starts=S.MAX_STARTS, rank_by="precision", seed=42, at_once=1000):
    """Forward-walking search of the bags' settings for all series:
    ``(folds, table, best)`` of ``walkforward``.

    ``grid`` gives values of ``bags``, ``ratio`` and ``rounds`` where they are not
    ``SEARCH_DEFAULTS``.  All folds and settings
    of ``at_once`` ensembles are fitted by the same jobs; fewer rounds are the first of
    more, so they share a fit.  Only the split table and the stumps of a block are on the
    driver.
    """
    grid = {**SEARCH_DEFAULTS, **grid}
    rows = binned.early().where("peak IS NOT NULL").select(*KEY, "peak", "bins")
    spark = rows.sparkSession
    numbered = staged(rows.withColumn("_row", F.row_number().over(by_date()) - 1), "numbered")
    splits = [r.asDict() for r in split_table(rows, max_starts).orderBy("series", "start_year", "fold").collect()]
    fits = [dict(zip(("bags", "ratio"), v)) for v in product(grid["bags"], grid["ratio"])]
    jobs = [(s, f) for s in splits for f in fits]
    folds = None
    for at in range(0, len(jobs), at_once):
        part = jobs[at : at + at_once]
        kind = "ensemble int, series string, skipped long, train_rows long, test_lo long, test_hi long, bags int, ratio double"
        table = [(e, *[s[c] for c in ("series", "skipped", "train_rows", "test_lo", "test_hi")], int(f["bags"]), float(f["ratio"])) for e, (s, f) in enumerate(part)]
        data = staged(fold_rows(numbered, spark.createDataFrame(table, kind)), "folds")
        most = max(f["bags"] for _, f in part)
        members = bag_members(data.where("part = 'train'"), "peak", KEY, ["ensemble"], F.col("bags"), F.col("ratio"))
        members = members.select((F.col("ensemble") * most + F.col("bag")).cast("int").alias("model"), "bins", F.col("peak").alias("y"))
        stumps = fit_stumps(members, len(part) * most, Draw(len(binned.names), seed=seed), max(grid["rounds"]))
        # an ensemble of the votes is a fit and a number of rounds
        shown = [(e, r) for e in range(len(part)) for r in grid["rounds"]]
        bags_of = [range(e * most, e * most + part[e][1]["bags"]) for e, _ in shown]
        places = [F.col("ensemble") * len(grid["rounds"]) + i for i in range(len(grid["rounds"]))]
        asked = data.withColumn("ensemble", F.explode(F.array(*places)))
        voted = bag_votes(asked, stumps, bags_of, [r for _, r in shown])
        labels = [(i, part[e][0]["series"], json.dumps({**part[e][1], "rounds": r}), part[e][0]["start_year"], part[e][0]["fold"]) for i, (e, r) in enumerate(shown)]
        labels = spark.createDataFrame(labels, "ensemble int, series string, params string, start_year int, fold int")
        scores = classification_metrics(voted, truth="peak", keys=["ensemble", "part"])
        done = staged(fold_table(scores, labels), "scores")
        folds = done if folds is None else folds.unionByName(done)
    table = search_table(folds, rank_by)
    return folds, table, best_parameters(table, rank_by)


# -- stored models --------------------------------------------------------------


def save_stage(binned, kind, model, place, rate=0.04):
    """All of a stage below ``place``: encoder, cuts, series, and the trees of every series
    (of peaks: fitted with the same settings for all).  The series hold their number of bags,
    as there may be no tree: bags without a peak have no rows."""
    spark = binned.rows.sparkSession
    binned.matrix.save(spark, f"{place}/encoder")
    binned.cuts.write.parquet(f"{place}/cuts")
    start = model[0] if kind == "counts" else [0.0] * len(binned.series)
    bags = 1 if kind == "counts" else len(model.done) // max(1, len(binned.series))
    rows = [(i, s, float(start[i]), binned.years, bags) for i, s in enumerate(binned.series)]
    spark.createDataFrame(rows, "model int, series string, start double, years boolean, bags int").write.parquet(f"{place}/series")
    trees = trees_table(spark, model[1], rate) if kind == "counts" else model.table(spark)
    trees.write.parquet(f"{place}/trees")


class StoredStage:
    """A stage read back; scores frames as the one that was stored."""

    def __init__(self, spark, place):
        rows = spark.read.parquet(f"{place}/series").orderBy("model").collect()
        self.series, self.start = [r["series"] for r in rows], [r["start"] for r in rows]
        self.years, self.bags = any(r["years"] for r in rows), max((r["bags"] for r in rows), default=0)
        self.matrix = Matrix.load(spark, f"{place}/encoder")
        self.cuts = spark.read.parquet(f"{place}/cuts")
        self.trees = spark.read.schema(STORED).parquet(f"{place}/trees")

    def binned(self, frame):
        return Binned.binned(self, Binned.slotted(self, frame)).where("model >= 0")

    def counts(self, frame):
        rate = self.trees.agg(F.max("vote")).first()[0]
        scored = boosted_values(self.binned(frame), self.start, trees_of(self.trees, len(self.series)), rate)
        return scored.select(*KEY, "prediction", "outcome")

    def peaks(self, frame):
        bags_of = [range(i * self.bags, (i + 1) * self.bags) for i in range(len(self.series))]
        stumps = Stumps.of_table(self.trees, self.bags * len(self.series))
        asked = self.binned(frame).withColumn("ensemble", F.col("model"))
        return bag_votes(asked, stumps, bags_of).select(*KEY, "prediction", "peak", "outcome")


def selection_forest(kind, trees=2000, depth=16, seed=42, least=1):
    """The forest the shadow features are tested with; ``least`` rows on either side of a
    split, so nodes of fewer than twice as many stay whole."""
    learner = RandomForestClassifier if kind == "peak" else RandomForestRegressor
    return learner(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, maxMemoryInMB=1024,
        featureSubsetStrategy="8", minInstancesPerNode=least, seed=seed,
    )


def predicted_peaks(frame, cut, selected=None, **bagging):
    """``(series, date, prediction, peak, outcome)`` from the cut date on.

    The training rows are staged once because every bag and tree reads them again.
    """
    categorical, numeric = column_kinds(frame)
    complete = frame.na.drop(subset=[*categorical, *numeric, "peak"])
    train, test = split_at(staged(complete, "peak-rows"), "date", cut)
    matrix, names = fit_matrix(train, categorical, numeric)
    slots = [n for n in names if selected is None or n in set(selected)]
    models = fit_bags(restrict(matrix(train), slots), "peak", KEY, features="selected", **bagging)
    scored = predict_bags(models, restrict(matrix(test), slots))
    return scored.select(*KEY, "prediction", "peak", "outcome"), models


def tune_peaks(train, grid, root, stamp, features="features", **search):
    """Search the bagging parameters forward in time and store the table.

    Returns the best parameters of each series; ``stored_parameters`` finds them again.
    """

    def fit(rows, **params):
        return fit_bags(rows, "peak", KEY, features=features, **params)

    results, best = forward_walk_search(train, grid, fit, predict_bags, "peak", **search)
    save_best(results.drop("date_run"), root, stamp)
    return best


def stored_parameters(spark, root, schema, series, rank_by="precision"):
    """Best parameters of a series in the newest stored search."""
    newest = load_latest(spark, root, schema).where(F.col("series") == series)
    row = newest.orderBy(F.desc(f"mean_test_{rank_by}"), "start_year", "params").first()
    return json.loads(row["params"])


def attach_peaks(frame, predicted, cut):
    """Before the cut the true peak is a feature, afterwards only the predicted one."""
    train, test = split_at(frame, "date", cut)
    guessed = predicted.select(*KEY, F.col("prediction").alias("peak"))
    return train.unionByName(test.drop("peak").join(guessed, KEY, "left").select(train.columns))


def predicted_counts(frame, predicted, cut, selected=None, trees=100, depth=7, rate=0.04,
                     rows=0.9, columns=0.14, seed=42):
    """``(series, date, prediction, outcome)`` from the cut date on, and the model."""
    categorical, numeric = column_kinds(frame, ["peak"])
    with_peaks = attach_peaks(frame, predicted, cut)
    complete = with_peaks.na.drop(subset=[*categorical, *numeric, "outcome"])
    train, test = split_at(staged(complete, "count-rows"), "date", cut)
    matrix, names = fit_matrix(train, categorical, numeric)
    slots = [n for n in names if selected is None or n in set(selected)]
    learner = GBTRegressor(
        featuresCol="selected", labelCol="outcome", maxIter=trees, maxDepth=depth, stepSize=rate,
        subsamplingRate=rows, featureSubsetStrategy=str(columns), seed=seed,
    )
    model = learner.fit(restrict(matrix(train), slots))
    scored = model.transform(restrict(matrix(test), slots))
    return scored.select(*KEY, "prediction", "outcome"), model
