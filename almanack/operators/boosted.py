"""Boosting of many models at once on the trees of ``manytrees``.

Rows, labels and weights stay in Spark: a round is one job over all models, which works
out the rows' residuals or weights from the trees since the state was last written.  The
state is written every ``KEEP`` rounds, so a lost executor costs a few rounds of tree
look-ups.  A fitted ensemble is a list of trees of each model, stored as rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from almanack.operators import manytrees as T
from almanack.sources.sinks import staged

KEEP = 10
#: a round's weights of an unerring stump
SURE = 1.0


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def sizes_of(rows, models):
    out = [0] * models
    for r in rows.groupBy("model").count().collect():
        out[r["model"]] = r["count"]
    return out


# -- shrunken trees on residuals ------------------------------------------------


def _predicted(trees, rate):
    """Adds the trees' share to ``p``."""

    def run(batches):
        for b in batches:
            model, bins = _column(b, "model").to_numpy(), T.matrix_of(_column(b, "bins"))
            p = _column(b, "p").to_numpy().copy()
            for t in trees:
                p += rate * t.values(model, bins)
            at = b.schema.get_field_index("p")
            yield pa.RecordBatch.from_arrays([pa.array(p) if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return run


def add_trees(rows, trees, rate):
    return rows.mapInArrow(_predicted(trees, rate), rows.schema) if trees else rows


def boost(rows, models, key, draw, trees=100, rate=0.04, share=0.9, rule=T.Rule(7, 1.0, 1.0), in_task=T.IN_TASK):
    """``(start values, trees)``: squared error, second-order steps.

    ``rows``: ``model``, ``bins``, ``y`` and the columns ``key``, by whose hash each tree
    draws ``share`` of the rows.  Start values are the models' means.
    """
    count = rows.groupBy("model").agg(F.avg("y").alias("start"), F.count(F.lit(1)).alias("n"))
    start, sizes = np.zeros(models), [0] * models
    for r in count.collect():
        start[r["model"]], sizes[r["model"]] = r["start"], r["n"]
    first = rows.join(count.select("model", F.col("start").alias("p")), "model")
    state = staged(first.select("model", "bins", "y", "p", *key), "boost")
    grown, since = [], []
    for number in range(trees):
        taken = F.pmod(F.xxhash64(*key, F.lit(draw.seed), F.lit(number)), F.lit(1 << 20)) < int(share * (1 << 20))
        now = add_trees(state.where(taken), since, rate).withColumns({"g": F.col("y") - F.col("p"), "w": F.lit(1.0)})
        tree = T.grow(now, sizes, number, draw, rule, in_task)
        grown.append(tree)
        since.append(tree)
        if len(since) == KEEP and number + 1 < trees:
            state, since = staged(add_trees(state, since, rate), "boost"), []
    return start, grown


def boosted_values(rows, start, trees, rate):
    """Adds ``prediction``."""
    known = F.array(*[F.lit(float(s)) for s in start])
    begun = rows.withColumn("p", F.get(known, F.col("model")))
    return add_trees(begun, trees, rate).withColumnRenamed("p", "prediction")


# -- reweighted stumps ------------------------------------------------------------


class Stumps:
    """What the rounds of reweighting have found: per model a list of
    ``(tree, vote)``."""

    def __init__(self, models):
        self.votes, self.trees, self.done = [], [], np.zeros(models, bool)

    def add(self, tree):
        """Votes of a round's trees, one of each model, by their weighted error; a model
        without errors, or no better than chance, is done."""
        leaf = tree.slot < 0
        there = np.zeros(tree.slot.shape, bool)
        there[:, 0] = True
        for node in range(tree.slot.shape[1] // 2):
            for child in (2 * node + 1, 2 * node + 2):
                there[:, child] = there[:, node] & ~leaf[:, node]
        weight = np.where(there & leaf, tree.weight, 0.0)
        share = np.clip(tree.value, 0.0, 1.0)
        wrong = (weight * np.minimum(share, 1 - share)).sum(axis=1)
        total = weight.sum(axis=1)
        error = np.divide(wrong, total, out=np.full(len(total), 0.5), where=total > 0)
        error = np.where(error < 1e-12, 0.0, error)
        with np.errstate(divide="ignore"):
            sure = np.where(error == 0, SURE, np.log((1 - error) / np.where(error == 0, 1.0, error)))
        # a first tree stays even if no better than chance, as the only opinion
        useless = (error >= 0.5) & (len(self.trees) > 0)
        vote = np.where(self.done | useless, 0.0, np.where(error >= 0.5, 1e-12, sure))
        self.trees.append(tree)
        self.votes.append(vote)
        self.done = self.done | (error == 0) | (error >= 0.5)

    def decision(self, model, bins, rounds=None):
        """Votes for less votes against, by all votes: from -1 to 1.  ``rounds``: of each
        row how many of the first rounds vote; boosting cut short is the same boosting."""
        total, all_votes = np.zeros(len(model)), np.zeros(len(model))
        for number, (tree, vote) in enumerate(zip(self.trees, self.votes)):
            own = vote[model] if rounds is None else vote[model] * (number < rounds)
            total += own * np.where(tree.values(model, bins) > 0.5, 1.0, -1.0)
            all_votes += own
        return np.divide(total, all_votes, out=np.zeros(len(total)), where=all_votes > 0)

    def table(self, spark):
        """``STORED`` rows."""
        votes = [r[:6] + (float(self.votes[r[1]][r[0]]),) for t, tree in enumerate(self.trees) for r in tree.rows(t)]
        return spark.createDataFrame(votes, STORED)

    @classmethod
    def of_table(cls, table, models):
        out = cls(models)
        out.trees = trees_of(table, models)
        out.votes = [np.zeros(models) for _ in out.trees]
        for r in table.where("node = 0").collect():
            out.votes[r["tree"]][r["model"]] = r["vote"]
        return out


STORED = "model int, tree int, node int, slot int, bin int, value double, vote double"


def trees_table(spark, trees, rate):
    """Trees whose values are all weighed by ``rate``, as ``STORED`` rows."""
    return spark.createDataFrame([r[:6] + (float(rate),) for t, tree in enumerate(trees) for r in tree.rows(t)], STORED)


def trees_of(table, models):
    """The trees that ``STORED`` rows hold, in order."""
    got = table.toArrow()
    if not got.num_rows:
        return []
    columns = {c: got[c].to_numpy() for c in ("model", "tree", "node", "slot", "bin", "value")}
    depth = int(np.log2(columns["node"].max() + 1))
    out = [T.Trees(models, depth) for _ in range(columns["tree"].max() + 1)]
    for number, tree in enumerate(out):
        own = columns["tree"] == number
        at = columns["model"][own], columns["node"][own]
        for name in ("slot", "bin", "value"):
            getattr(tree, name)[at] = columns[name][own]
    return out


def _log_weights(batch, trees, votes):
    """The logarithm of each row's weight after further trees, and the columns used."""
    model, bins = _column(batch, "model").to_numpy(), T.matrix_of(_column(batch, "bins"))
    lw, y = _column(batch, "lw").to_numpy().copy(), _column(batch, "y").to_numpy()
    for tree, vote in zip(trees, votes):
        lw += vote[model] * ((tree.values(model, bins) > 0.5) != (y > 0.5))
    return model, y, lw


def _reweighted(trees, votes):
    def run(batches):
        for b in batches:
            lw = pa.array(_log_weights(b, trees, votes)[2])
            at = b.schema.get_field_index("lw")
            yield pa.RecordBatch.from_arrays([lw if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return run


def _weighed(trees, votes, top, done):
    """``model, bins, g, w`` of the models that go on; ``top`` is the logarithm of the
    largest weight a row of a model can have."""

    def run(batches):
        for b in batches:
            model, y, lw = _log_weights(b, trees, votes)
            w = np.exp(lw - top[model])
            arrays = [_column(b, "model"), _column(b, "bins"), pa.array(w * y), pa.array(w)]
            yield pa.RecordBatch.from_arrays(arrays, names=["model", "bins", "g", "w"]).filter(pa.array(~done[model]))

    return run


def fit_stumps(rows, models, draw, rounds=50, depth=1, in_task=T.IN_TASK):
    """Adaptive boosting of every model: each round's tree is grown on weights that grew
    by the vote of each earlier tree that was wrong there.

    ``rows``: ``model``, ``bins`` and ``y`` (0 or 1).  Weights are scaled per model by the
    largest possible one, which changes no split and no vote.
    """
    sizes = sizes_of(rows, models)
    state = staged(rows.select("model", "bins", F.col("y").cast("double").alias("y"), F.lit(0.0).alias("lw")), "weights")
    found, rule, kept, top = Stumps(models), T.Rule(depth), 0, np.zeros(models)
    for number in range(rounds):
        live = [0 if done else n for n, done in zip(sizes, found.done)]
        if not any(live):
            break
        since = found.trees[kept:], found.votes[kept:]
        now = state.mapInArrow(_weighed(*since, top, found.done), "model int, bins binary, g double, w double")
        found.add(T.grow(now, live, number, draw, rule, in_task))
        top = top + found.votes[-1]
        if len(found.trees) - kept == KEEP and number + 1 < rounds:
            state = state.mapInArrow(_reweighted(found.trees[kept:], found.votes[kept:]), state.schema)
            state, kept = staged(state, "weights"), len(found.trees)
    return found


def _voted(stumps, members, rounds):
    """``members``: the models of each ensemble, a row each, filled up with -1."""

    def run(batches):
        for b in batches:
            group, bins = _column(b, "ensemble").to_numpy(), T.matrix_of(_column(b, "bins"))
            limit = None if rounds is None else rounds[group]
            total, many = np.zeros(len(group)), np.zeros(len(group))
            for bag in members.T:
                model = bag[group]
                own = model >= 0
                decision = stumps.decision(np.maximum(model, 0), bins, limit)
                total += np.where(own, 1 / (1 + np.exp(-decision)), 0.0)
                many += own
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total / np.maximum(many, 1))], names=[*b.schema.names, "probability"])

    return run


def bag_votes(rows, stumps, members, rounds=None):
    """Adds ``probability``, the mean over the bags of each row's ``ensemble``, and
    ``prediction``.  ``members``: the models of each ensemble; ``rounds``: how many
    rounds of each ensemble vote, all by default."""
    wide = max((len(m) for m in members), default=0)
    of = np.array([[*m, *[-1] * (wide - len(m))] for m in members], np.int64).reshape(len(members), wide)
    limit = None if rounds is None else np.asarray(rounds)
    schema = StructType([*rows.schema.fields, StructField("probability", DoubleType())])
    voted = rows.mapInArrow(_voted(stumps, of, limit), schema)
    return voted.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
