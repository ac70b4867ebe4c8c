"""Nearest neighbours by a vantage-point tree per shard.

An inner node of a tree is a point with the ranges of distances of the points nearer
to it and of those farther off, split at the median; a leaf holds up to ``LEAF`` points.
A query's distance to a vantage point bounds its distance to either side by the triangle
inequality.  A leaf is left out when its bound times ``factor`` exceeds the distance of
the query's k-th nearest so far: factor one leaves out nothing that belongs to the
answer, larger factors leave out more and may miss.

The trees are a table, one row per node, so the index outlives the executors that built
it.  In a task the queries of a batch go through a tree together: bounds level by level,
then every query's most promising leaf, then leaf by leaf the queries still open.

A score is the root of the sum of squared differences, added in the order of the
components.  Candidates are screened by a matrix product whose error is bounded and
decided by their score.

Defined results: rows without an id and vectors that are null, empty or zero or hold null
or non-finite components take no part; only vectors of one length are compared; an id
that is there several times stands for one row (``vectors``); distances beyond the range
of doubles are infinite and tie; an empty table gives no rows; other columns are left.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from almanack.llm import vectors as V
from almanack.llm.base import register, staged, table

K = 10
EVERY = 100
FACTOR = 1.0
LEAF = 64
VANTAGES = 4
NODE = "size int, shard int, node long, bounds array<double>, ids array<long>, v array<double>"


def distances(a, b):
    """Rows of ``a`` against rows of ``b`` (or one row), added component by component."""
    total = np.zeros(max(len(a), len(b)))
    with np.errstate(over="ignore"):
        for j in range(a.shape[1]):
            gap = a[:, j] - b[:, j]
            total += gap * gap
    return np.sqrt(total)


def build(ids, x, seed):
    """``(node, bounds, rows)`` of a tree; children of ``i`` are ``2i + 1`` and ``2i + 2``."""
    rng = np.random.default_rng(seed)
    open_nodes = [(0, np.argsort(ids, kind="stable"))]
    while open_nodes:
        node, own = open_nodes.pop()
        if len(own) <= LEAF:
            yield node, None, own
            continue
        some = own[rng.choice(len(own), min(len(own), LEAF), replace=False)]
        spread = [np.nan_to_num(distances(x[some], x[p : p + 1]).std()) for p in some[:VANTAGES]]
        vantage = some[int(np.argmax(spread))]
        rest = own[own != vantage]
        d = distances(x[rest], x[vantage : vantage + 1])
        order = np.argsort(d, kind="stable")
        half = len(rest) // 2
        near, far = order[:half], order[half:]
        yield node, [d[near[0]], d[near[-1]], d[far[0]], d[far[-1]]], np.array([vantage])
        open_nodes += [(2 * node + 1, rest[near]), (2 * node + 2, rest[far])]


def _trees(batches):
    def tree(key, parts):
        size, shard = key
        ids = np.concatenate([p.column(2).to_numpy() for p in parts])
        x = np.concatenate([V.matrix(p.column(3), size) for p in parts])
        rows = [(node, bounds or [], ids[own], x[own].ravel()) for node, bounds, own in build(ids, x, size)]
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            yield pa.RecordBatch.from_pydict(
                {"size": [size] * len(some), "shard": [shard] * len(some), **{c: [r[i] for r in some] for i, c in enumerate(("node", "bounds", "ids", "v"))}},
                schema=pa.schema([("size", pa.int32()), ("shard", pa.int32()), ("node", pa.int64()), ("bounds", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))]),
            )

    key, parts = None, []
    for batch in batches:
        size, shard = (batch.column(c).to_numpy() for c in (0, 1))
        edge = np.flatnonzero((size[1:] != size[:-1]) | (shard[1:] != shard[:-1])) + 1
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
            if s == e:
                continue
            if key != (int(size[s]), int(shard[s])) and parts:
                yield from tree(key, parts)
                parts = []
            key = (int(size[s]), int(shard[s]))
            parts.append(batch.slice(s, e - s))
    if parts:
        yield from tree(key, parts)


class Tree:
    """The rows of a shard's index as a task holds them."""

    def __init__(self, size, batches):
        self.inner, self.leaves = [], []
        for b in batches:
            node, bounds, ids, v = (b.column(b.schema.get_field_index(c)) for c in ("node", "bounds", "ids", "v"))
            for i, number in enumerate(node.to_pylist()):
                x = v[i].values.to_numpy().reshape(-1, size)
                limits = bounds[i].as_py()
                entry = (number, limits, ids[i].values.to_numpy(), x)
                (self.inner if limits else self.leaves).append(entry)
        self.inner.sort(key=lambda n: n[0])
        self.leaves.sort(key=lambda n: n[0])
        self.squares = [(x * x).sum(axis=1) for *_, x in self.leaves]

    def bounds(self, q, offer):
        """Least distance of each query to each leaf's points; vantage points are offered."""
        lowest = {0: np.zeros(len(q))}
        for number, (a, b, c, d), ids, x in self.inner:
            far = distances(q, x)
            offer(np.arange(len(q)), ids, x, far)
            own = lowest.pop(number)
            with np.errstate(invalid="ignore"):
                for child, low, high in ((2 * number + 1, a, b), (2 * number + 2, c, d)):
                    bound = np.maximum(far - high, low - far) - 1e-12 * (far + high) - 1e-150
                    lowest[child] = np.maximum(own, np.where(np.isfinite(bound), bound, 0.0))
        return np.stack([lowest[n] for n, *_ in self.leaves], axis=1)

    def search(self, ids, q, k, factor):
        """``(query place, id, score)`` of each query's ``k`` nearest, and the number of
        (query, leaf) visits."""
        best = np.full((len(q), k), np.inf)
        names = np.full((len(q), k), -1)
        taken = np.zeros(len(q), int)
        squares = (q * q).sum(axis=1)
        error = 4 * (q.shape[1] + 4) * np.finfo(float).eps

        def keep(row, found, score):
            own = found != ids[row]
            row, found, score = row[own], found[own], score[own]
            if not len(row):
                return
            at = np.unique(row)
            old = np.repeat(at, taken[at])
            place = np.arange(len(old)) - np.repeat(np.cumsum(taken[at]) - taken[at], taken[at])
            rows = np.r_[old, row]
            scores, found = np.r_[best[old, place], score], np.r_[names[old, place], found]
            first, rank = V.first_of_each(rows, (scores, found), k)
            best[rows[first], rank], names[rows[first], rank] = scores[first], found[first]
            np.maximum.at(taken, rows[first], rank + 1)

        def offer(open_queries, points, x, far):
            row, column = np.nonzero((~(far > best[open_queries, -1]))[:, None] & np.ones((1, len(points)), bool))
            keep(open_queries[row], points[column], far[row])

        def visit(leaf, open_queries):
            _, _, points, x = self.leaves[leaf]
            for part in np.array_split(open_queries, max(1, len(open_queries) * len(points) // V.AT_ONCE)):
                with np.errstate(over="ignore", invalid="ignore"):
                    size = squares[part][:, None] + self.squares[leaf]
                    rough = size - 2 * (q[part] @ x.T)
                    beyond = rough - error * size > (best[part, -1] ** 2 * (1 + error))[:, None]
                row, column = np.nonzero(~beyond)
                keep(part[row], points[column], distances(q[part[row]], x[column]))

        low = self.bounds(q, offer)
        nearest = low.argmin(axis=1)
        for leaf in np.unique(nearest):
            visit(leaf, np.flatnonzero(nearest == leaf))
        visited = len(q)
        for leaf in np.argsort(low.mean(axis=0), kind="stable"):
            still = np.flatnonzero((low[:, leaf] * factor <= best[:, -1]) & (nearest != leaf))
            if len(still):
                visit(leaf, still)
                visited += len(still)
        row, place = np.nonzero(np.arange(k) < taken[:, None])
        return row, names[row, place], best[row, place], visited


def _searched(k, factor):
    def run(batches):
        tree, of = None, None
        for size, rows, asked in V.visits(batches):
            if of is not rows:
                tree, of = Tree(size, rows), rows
            names, values = (asked.column(asked.schema.get_field_index(c)) for c in ("ids", "v"))
            ids, q = V.matrix(names, 1)[:, 0], V.matrix(values, size)
            step = max(1, V.AT_ONCE // max(1, len(tree.leaves)))
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                row, found, score, _ = tree.search(part, q[at : at + step], k, factor)
                yield pa.RecordBatch.from_arrays([pa.array(part[row]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


def points_of(vectors, vec_id="vec_id", embedding="embedding"):
    return V.one_per_id(V.usable(vectors, vec_id, embedding).where(F.exists("v", lambda x: x != 0)))


def index(points, shards):
    """The trees of all shards, a row per node."""
    dealt = V.in_shards(points, shards).repartition(2 * shards, "size", "shard").sortWithinPartitions("size", "shard")
    return dealt.select("size", "shard", "id", "v").mapInArrow(_trees, NODE)


def search(trees, queries, shards, k=K, factor=FACTOR):
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest in ``trees``, nearest
    first, ties to the smaller id; a point with the query's id is no candidate."""
    asking = V.in_every_shard(queries.select("id", "v"), shards).select("size", "shard", F.array("id").alias("ids"), "v")
    both = V.meeting(trees, asking, shards)
    found = both.mapInArrow(_searched(k, factor), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors, asks, vec_id="vec_id", embedding="embedding", k=K, factor=FACTOR):
    """The ``k`` nearest rows of ``vectors`` to those of its rows for whose ``id`` the
    condition ``asks`` holds."""
    points = staged(points_of(vectors, vec_id, embedding), "points")
    shards = V.shard_count(points)
    trees = staged(index(points, shards), "trees")
    return search(trees, points.where(asks), shards, k, factor)


SQL = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT vec_id, min(e) AS e FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL
  AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0 GROUP BY vec_id),
d AS (SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_reduce([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(q.e, c.e)], lambda s, x: s + x)) AS score
  FROM g q JOIN g c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""


@register("op11_vantage_point_trees", SQL)
def op11_vantage_point_trees(spark, folder):
    return nearest(table(spark, folder, "embeddings"), F.col("id") % EVERY == 0)
