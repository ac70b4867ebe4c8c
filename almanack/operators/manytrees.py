"""Regression trees for many models at once, by histograms.

A model is one of many fits that share their feature slots: a series, a bag of a series,
a fold of a search.  Rows carry ``model`` and their slots as bins, and a level of the
trees of all models is one job, so the number of jobs does not grow with the models.

A node with more than ``IN_TASK`` rows is split by histograms: partitions add up their
rows per slot and bin, the sums meet by node, and the best split is chosen there.  Smaller
nodes are brought to one task each, which grows what is left of their trees.  The same
split function decides in both.

What the driver holds of a tree is its nodes, at most ``2 ** (depth + 1)`` a model.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

BINS = 32
IN_TASK = 1 << 16
NODE = "model int, node long, slot int, bin int, value double, weight double, many long"


# -- bins -------------------------------------------------------------------


def bin_cuts(rows, slots="slots", keys=("series",), bins=BINS):
    """``(*keys, cuts)``: for each slot the ascending values at which bins end.

    Quantile sketches per slot combine on the map side; a slot that is never known has
    no cut.
    """
    cells = rows.select(*keys, F.posexplode(slots).alias("_slot", "_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    shares = [i / bins for i in range(1, bins)]
    found = cells.groupBy(*keys, "_slot").agg(F.array_distinct(F.percentile_approx("_v", shares, 1000)).alias("_c"))
    return found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_c"))).alias("cuts"))


def with_bins(df, cuts, slots="slots", keys=("series",)):
    """Adds ``bins``, a byte per slot: 0 where the slot is missing, else 1 and the number
    of cuts below the value.  A byte array is read by Python without a copy."""
    def place(v, i):
        below = F.filter(F.coalesce(F.try_element_at("cuts", i), F.array().cast("array<double>")), lambda c: c < v)
        return F.when(v.isNull() | F.isnan(v), 0).otherwise(1 + F.size(below))

    digits = F.transform(F.transform(slots, place), lambda b: F.lpad(F.hex(b), 2, "0"))
    return df.join(cuts, list(keys), "left").withColumn("bins", F.unhex(F.array_join(digits, ""))).drop("cuts")


def matrix_of(column):
    """Byte arrays of one length as rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


# -- drawing slots ------------------------------------------------------------


@dataclass(frozen=True)
class Draw:
    """Which slots a level of a tree may split on: a share of the allowed ones per tree, and
    of these a share per level, at least one each; fixed by the seed, model, tree and level."""

    slots: int
    per_tree: float = 1.0
    per_level: float = 1.0
    seed: int = 0
    allowed: tuple = ()  # of each model the slots it may use; empty: all

    def of(self, model, tree, level):
        own = np.asarray(self.allowed[model]) if self.allowed else np.arange(self.slots)
        for share, key in ((self.per_tree, (self.seed, model, tree)), (self.per_level, (self.seed, model, tree, level + 1))):
            if share < 1 and len(own):
                own = np.random.default_rng(key).permutation(own)[: max(1, int(share * len(own)))]
        return np.sort(own)


# -- splits -------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Gain ``g**2 / (w + penalty)`` per side; a side weighs at least ``least``."""

    depth: int
    penalty: float = 0.0
    least: float = 0.0


def best_split(g, w, rule):
    """``(place among the slots, bin)`` of the split with the largest gain, the first of
    equals, or none.  ``g``, ``w``: sums per slot and bin."""
    left_g, left_w = g.cumsum(axis=1)[:, :-1], w.cumsum(axis=1)[:, :-1]
    whole_g, whole_w = g.sum(axis=1, keepdims=True), w.sum(axis=1, keepdims=True)
    right_g, right_w = whole_g - left_g, whole_w - left_w
    floor = max(rule.least, 1e-12 * float(whole_w.max(initial=0)))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g ** 2 / (left_w + rule.penalty) + right_g ** 2 / (right_w + rule.penalty)
        gain -= whole_g ** 2 / (whole_w + rule.penalty)
    gain = np.where((left_w >= floor) & (right_w >= floor) & (left_w > 0) & (right_w > 0), gain, -np.inf)
    if not gain.size:
        return None
    at = int(gain.argmax())
    top = gain.flat[at]
    # rounding is no gain
    small = 1e-12 * float((whole_g ** 2).max() / (whole_w.max() + rule.penalty) + 1e-300)
    return divmod(at, gain.shape[1]) if top > small else None


def sums(bins, slots, *values):
    """Sums of each of ``values`` per slot and bin."""
    own = bins[:, slots] + (np.arange(len(slots)) * (BINS + 1))[None, :]
    size = len(slots) * (BINS + 1)
    total = [np.bincount(own.ravel(), weights=np.repeat(v, len(slots)), minlength=size) for v in values]
    return [t.reshape(len(slots), BINS + 1) for t in total]


def mean(g, w, rule):
    return float(g) / (float(w) + rule.penalty) if w + rule.penalty > 0 else 0.0


def subtree(bins, g, w, model, tree, node, level, draw, rule):
    """Nodes from ``node`` down, for rows of one node."""
    waiting = [(node, level, np.arange(len(g)))]
    while waiting:
        node, level, own = waiting.pop()
        weight = float(w[own].sum())
        value = mean(g[own].sum(), weight, rule)
        split = None
        if level < rule.depth and len(own) > 1:
            slots = draw.of(model, tree, level)
            if len(slots):
                split = best_split(*sums(bins[own], slots, g[own], w[own]), rule)
        if split is None:
            yield model, node, -1, -1, value, weight, len(own)
            continue
        slot, cut = int(slots[split[0]]), int(split[1])
        yield model, node, slot, cut, value, weight, len(own)
        right = bins[own, slot] > cut
        waiting += [(2 * node + 2, level + 1, own[right]), (2 * node + 1, level + 1, own[~right])]


# -- jobs ---------------------------------------------------------------------


class Trees:
    """One tree of each model, as arrays by node."""

    def __init__(self, models, depth):
        nodes = 2 ** (depth + 1) - 1
        self.slot = np.full((models, nodes), -1, np.int32)
        self.bin = np.full((models, nodes), -1, np.int32)
        self.value = np.zeros((models, nodes))
        self.weight = np.zeros((models, nodes))

    def add(self, found):
        model, node = found["model"].to_numpy(), found["node"].to_numpy()
        for name in ("slot", "bin", "value", "weight"):
            getattr(self, name)[model, node] = found[name].to_numpy()

    def leaves(self, model, bins):
        """The node each row ends in."""
        node, rows = np.zeros(len(model), np.int64), np.arange(len(model))
        while True:
            slot = self.slot[model, node]
            go = slot >= 0
            if not go.any():
                return node
            right = bins[rows, np.maximum(slot, 0)] > self.bin[model, node]
            node = np.where(go, 2 * node + 1 + right, node)

    def values(self, model, bins):
        return self.value[model, self.leaves(model, bins)]

    def rows(self, tree):
        """``(model, tree, node, slot, bin, value)`` of the nodes there are."""
        there = np.zeros(self.slot.shape, bool)
        there[:, 0] = True
        for node in range(self.slot.shape[1] // 2):
            split = there[:, node] & (self.slot[:, node] >= 0)
            there[:, 2 * node + 1] |= split
            there[:, 2 * node + 2] |= split
        for model, node in np.argwhere(there).tolist():
            yield model, tree, node, int(self.slot[model, node]), int(self.bin[model, node]), float(self.value[model, node])


def by_key(batches, keys):
    """Arrow tables of one key each, from rows sorted by ``keys``; a key's rows are one
    group that the caller has bounded."""
    held, of = [], None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
            if s == e:
                continue
            key = tuple(int(c[s]) for c in columns)
            if key != of and held:
                yield of, pa.Table.from_batches(held).combine_chunks()
                held = []
            of = key
            held.append(batch.slice(s, e - s))
    if held:
        yield of, pa.Table.from_batches(held).combine_chunks()


_KINDS = {"model": pa.int32(), "node": pa.int64(), "slot": pa.int32(), "bin": pa.int32(), "value": pa.float64(), "weight": pa.float64(), "many": pa.int64()}


def _node_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _KINDS.values())], names=list(_KINDS))


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _placed(trees, wanted):
    """Adds the node each row has come to; rows in other nodes than the ``wanted`` go."""
    there = np.zeros(trees.slot.shape, bool)
    for model, node in wanted:
        there[model, node] = True

    def run(batches):
        for b in batches:
            model, bins = _column(b, "model").to_numpy(), matrix_of(_column(b, "bins"))
            node = trees.leaves(model, bins)
            own = pa.array(there[model, node])
            yield pa.RecordBatch.from_arrays([_column(b, c) for c in ("model", "bins", "g", "w")] + [pa.array(node)], names=["model", "bins", "g", "w", "node"]).filter(own)

    return run


_LISTS = pa.schema([("model", pa.int32()), ("node", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("gs", "ws", "ns")]])


def _histograms(tree, level, draw):
    """Per partition: sums per node, slot and bin, as lists."""

    def run(batches):
        held = {}
        for b in batches:
            model, node, g, w = (_column(b, c).to_numpy() for c in ("model", "node", "g", "w"))
            bins = matrix_of(_column(b, "bins"))
            for key in set(zip(model.tolist(), node.tolist())):
                own = (model == key[0]) & (node == key[1])
                got = sums(bins[own], draw.of(key[0], tree, level), g[own], w[own], np.ones(own.sum()))
                held[key] = [a + b for a, b in zip(held[key], got)] if key in held else got
        for (m, n), lists in held.items():
            columns = {"model": [m], "node": [n], **{c: [x.ravel()] for c, x in zip(("gs", "ws", "ns"), lists)}}
            yield pa.RecordBatch.from_pydict(columns, schema=_LISTS)

    return run


def _chosen(tree, level, draw, rule):
    """The split of each node from the partitions' sums, and the two sides."""

    def run(batches):
        for (model, node), t in by_key(batches, ("model", "node")):
            slots = draw.of(model, tree, level)
            g, w, n = (np.sum([c.values.to_numpy() for c in t.column(name).chunk(0)], axis=0).reshape(len(slots), -1) for name in ("gs", "ws", "ns"))
            place, cut = best_split(g, w, rule) or (0, -1)
            sides = [[float(x[place, part].sum()) for x in (g, w, n)] for part in (slice(None), slice(0, cut + 1), slice(cut + 1, None))]
            rows = []
            for at, (sg, sw, sn) in zip((node, 2 * node + 1, 2 * node + 2), sides if cut >= 0 else sides[:1]):
                split = (int(slots[place]), int(cut)) if cut >= 0 and at == node else (-1, -1)
                rows.append((model, at, *split, mean(sg, sw, rule), sw, int(sn)))
            yield _node_batch(rows)

    return run


def _grown(tree, draw, rule):
    def run(batches):
        for (model, node), t in by_key(batches, ("model", "node")):
            bins = matrix_of(t.column("bins"))
            g, w = (t.column(c).to_numpy() for c in ("g", "w"))
            # sums round alike however the rows came
            order = np.lexsort((w, g))
            level = int(np.log2(node + 1))
            yield _node_batch(list(subtree(bins[order], g[order], w[order], model, tree, node, level, draw, rule)))

    return run


def grow(rows, sizes, tree, draw, rule, in_task=IN_TASK):
    """One tree for each model.

    ``rows``: ``model``, ``bins``, ``g`` (weight times target) and ``w`` (weight);
    ``sizes``: the number of rows of each model.  Every model has a slot to split on.
    """
    trees = Trees(len(sizes), rule.depth)
    rows = rows.select("model", "bins", "g", "w")
    placed = "model int, bins binary, g double, w double, node long"
    large = {(m, 0) for m, n in enumerate(sizes) if n > in_task}
    small = {(m, 0) for m, n in enumerate(sizes) if n <= in_task}
    for level in range(rule.depth):
        if not large:
            break
        found = rows.mapInArrow(_placed(trees, large), placed)
        found = found.mapInArrow(_histograms(tree, level, draw), "model int, node long, gs array<double>, ws array<double>, ns array<double>")
        found = found.repartition("model", "node").sortWithinPartitions("model", "node")
        got = found.mapInArrow(_chosen(tree, level, draw, rule), NODE).toArrow()
        trees.add(got)
        below = [(m, n, many) for m, n, many in zip(*(got[c].to_pylist() for c in ("model", "node", "many"))) if n >= 2 ** (level + 1) - 1]
        large = {(m, n) for m, n, many in below if many > in_task}
        if level + 1 < rule.depth:
            small |= {(m, n) for m, n, many in below if many <= in_task}
    if small:
        waiting = rows.mapInArrow(_placed(trees, small), placed)
        waiting = waiting.repartition("model", "node").sortWithinPartitions("model", "node")
        trees.add(waiting.mapInArrow(_grown(tree, draw, rule), NODE).toArrow())
    return trees
