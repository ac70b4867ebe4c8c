"""Slots of many models against shuffled copies of themselves, in forests of one job.

A model's rows, at most ``manytrees.IN_TASK``, go to some tasks as bins, and each task
grows a few of the model's trees: a level of them at once, by sums per node, drawn slot and
bin.  Tasks give out the slots' gains alone, so the driver holds a number per slot and copy.

Trees are as in Spark's forests: rows drawn with repeats, slots drawn at every node, gains by
variance, which for labels 0 and 1 rank as by Gini impurity; each tree's gains add up to one.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from almanack.operators import manytrees as T

#: Trees a task grows of a model, and (tree, row) pairs it grows at once.
TREES, AT_ONCE = 12, 1 << 16
WIDE = T.BINS + 1


def tree_gains(bins, y, weights, rng, drawn, depth, least):
    """Gains per tree and slot.  ``weights``: how often each tree (row) drew each row;
    ``drawn``: slots a node may split on; a side holds at least ``least`` drawn rows."""
    slots = bins.shape[1]
    drawn = min(drawn, slots)
    out = np.zeros((len(weights), slots))
    of, (node, row) = np.arange(len(weights)), np.nonzero(weights)
    w = weights[node, row].astype(float)
    g = w * y[row]
    for _ in range(depth):
        heavy = np.bincount(node, w, len(of)) >= 2 * least
        own = heavy[node]
        node, row, w, g = (np.cumsum(heavy) - 1)[node[own]], row[own], w[own], g[own]
        of = of[heavy]
        if not len(of):
            break
        picked = rng.random((len(of), slots)).argpartition(drawn - 1, axis=1)[:, :drawn]
        cell = (node[:, None] * drawn + np.arange(drawn)) * WIDE + bins[row[:, None], picked[node]]
        left_w, left_g = (
            np.bincount(cell.ravel(), np.repeat(v, drawn), len(of) * drawn * WIDE).reshape(-1, drawn, WIDE).cumsum(axis=2) for v in (w, g)
        )
        whole_w, whole_g = left_w[:, :1, -1:], left_g[:, :1, -1:]
        left_w, left_g = left_w[:, :, :-1], left_g[:, :, :-1]
        right_w, right_g = whole_w - left_w, whole_g - left_g
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g ** 2 / left_w + right_g ** 2 / right_w - whole_g ** 2 / whole_w
        gain = np.where((left_w >= least) & (right_w >= least), gain, -np.inf).reshape(len(of), -1)
        at = gain.argmax(axis=1)
        top = gain[np.arange(len(of)), at]
        place, cut = np.divmod(at, WIDE - 1)
        # rounding is no gain
        split = top > 1e-12 * (left_g ** 2 / np.maximum(left_w, 1)).max(axis=(1, 2)) + 1e-300
        slot = picked[np.arange(len(of)), place]
        np.add.at(out, (of[split], slot[split]), top[split])
        own = split[node]
        node, row, w, g = node[own], row[own], w[own], g[own]
        right = bins[row, slot[node]] > cut[node]
        node, of = 2 * (np.cumsum(split) - 1)[node] + right, np.repeat(of[split], 2)
    return out


def forest_gains(bins, y, seeds, drawn, depth, least):
    """The sum over trees, one for each of ``seeds``, of each slot's share of the gains."""
    total, step = np.zeros(bins.shape[1]), max(1, AT_ONCE // max(1, len(y)))
    y = y - y.mean()
    for at in range(0, len(seeds), step):
        rngs = [np.random.default_rng(s) for s in seeds[at : at + step]]
        weights = np.array([r.poisson(1.0, len(y)) for r in rngs])
        gains = tree_gains(bins, y, weights, rngs[0], drawn, depth, least)
        whole = gains.sum(axis=1, keepdims=True)
        total += np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
    return total


_GAINS = pa.schema([("model", pa.int32()), ("part", pa.int32()), ("gains", pa.list_(pa.float64()))])


def _shadowed(seed, kept, trees, drawn, depth, least):
    """Rows sorted by model, part and a hash: every part of a model makes the same copies."""

    def run(batches):
        for (model, part), t in T.by_key(batches, ("model", "part")):
            bins = T.matrix_of(t.column("bins"))[:, kept[model]]
            both = np.hstack([bins, np.random.default_rng((seed, model)).permuted(bins, axis=0)])
            own = [(seed, model, 1 + n) for n in range(part * TREES, min((part + 1) * TREES, trees[model]))]
            gains = forest_gains(both, t.column("y").to_numpy(), own, drawn, depth, least)
            yield pa.RecordBatch.from_pydict({"model": [model], "part": [part], "gains": [gains]}, schema=_GAINS)

    return run


def shadow_gains(rows, kept, trees, seed, drawn=8, depth=16, least=5):
    """``{model: gains}`` of the models in ``kept``: of their kept slots, then of the copies
    of these, every copy permuted on its own over the model's rows.

    ``rows``: ``model``, ``at`` (a hash of the row's key), ``bins`` and ``y``; ``kept`` and
    ``trees``: slots and number of trees of each model.
    """
    parts = {m: -(-trees[m] // TREES) for m in kept}
    pairs = [x for m, n in parts.items() for x in (F.lit(m), F.lit(n - 1))]
    own = rows.where(F.col("model").isin(list(kept))).withColumn("_last", F.create_map(*pairs)[F.col("model")])
    own = own.select("model", F.explode(F.sequence(F.lit(0), "_last")).alias("part"), "at", "bins", "y")
    own = own.repartition(sum(parts.values()), "model", "part").sortWithinPartitions("model", "part", "at")
    slots = {m: np.asarray(s) for m, s in kept.items()}
    found = own.mapInArrow(_shadowed(seed, slots, dict(trees), drawn, depth, least), "model int, part int, gains array<double>")
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["model"], r["part"])):
        out[r["model"]] = out.get(r["model"], 0.0) + np.asarray(r["gains"])
    return out
