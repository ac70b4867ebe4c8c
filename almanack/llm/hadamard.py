"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; the
hash is the axis, with its sign, that lies closest.  A table concatenates ``AXES`` such
hashes of independent rotations; each vector is also put into the buckets that swap one
hash for its runner-up (multiprobe).  Pairs that share a bucket are verified by their
cosine in double precision.

Equal vectors are one class and enter once with their count.  Buckets are cut into
blocks and pairs of blocks are the unit of work, so a hot bucket is spread; a block pair
gives counts of links per vector and a spanning forest of its links, never the pairs.
A pair that meets in several buckets is counted only in the first of them, which each
task decides from the bucket lists that the two vectors carry.

Defined results: null or zero vectors, vectors with null or non-finite components, and
empty ones link with nothing and are components of their own; vectors of different
lengths do not link; ids should be unique (rows of a repeated id are one vector if equal;
otherwise their links are added up); rows without an id link with nothing.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from almanack.llm.base import paired_blocks, register, smallest_labels, staged, table, whole_groups
from almanack.llm.components import components

COSINE = 0.9
TABLES, AXES, PROBES = 16, 3, 2
BLOCK = 256
SEED = 11


def _rotations(size, count, seed):
    wide = 1 << max(0, int(size - 1).bit_length())
    rng = np.random.default_rng([seed, size])
    return rng.choice([-1.0, 1.0], size=(count, 3, wide))


def hadamard(x):
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def buckets(unit, tables=TABLES, axes=AXES, probes=PROBES, seed=SEED):
    """Bucket numbers of each row: ``tables`` times (1 + axes * (probes - 1)) columns."""
    n, size = unit.shape
    signs = _rotations(size, tables * axes, seed)
    wide = signs.shape[2]
    padded = np.zeros((n, wide))
    padded[:, :size] = unit
    probes = min(probes, 2 * wide)
    near = np.empty((tables, axes, probes, n), np.int64)
    for t in range(tables):
        for a in range(axes):
            y = padded
            for turn in signs[t * axes + a]:
                y = hadamard(y * turn)
            both = np.concatenate((y, -y), axis=1)
            best = np.argpartition(-both, probes - 1, axis=1)[:, :probes] if probes < 2 * wide else np.argsort(-both, axis=1)
            order = np.argsort(-np.take_along_axis(both, best, axis=1), axis=1, kind="stable")
            near[t, a] = np.take_along_axis(best, order, axis=1).T
    out = []
    for t in range(tables):
        choices = [(0,) * axes] + [tuple(p if b == a else 0 for b in range(axes)) for a in range(axes) for p in range(1, probes)]
        for c in choices:
            code = np.full(n, t)
            for a in range(axes):
                code = code * (2 * wide) + near[t, a, c[a]]
            out.append(code)
    return np.stack(out, axis=1) * 4096 + size % 4096


def _hashed(batches):
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        flat = lists.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
        counts = np.asarray(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        starts = np.cumsum(counts) - counts
        for size in np.unique(counts):
            if size == 0:
                continue
            rows = np.flatnonzero(counts == size)
            for part in np.array_split(rows, max(1, -(-len(rows) * int(size) // (1 << 18)))):
                x = values[starts[part][:, None] + np.arange(size)]
                # scaled first, so that no square overflows or vanishes
                top = np.abs(x).max(axis=1, keepdims=True)
                x = x / top
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                codes = buckets(unit)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(part)),
                        pa.ListArray.from_arrays(np.arange(0, (len(part) + 1) * size, size, dtype=np.int32), unit.ravel()),
                        pa.ListArray.from_arrays(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32), codes.ravel()),
                    ],
                    names=["id", "unit", "codes"],
                )


def _new_in(x, y, bucket, probes):
    """Which pairs of bucket lists have no common bucket before ``bucket``."""
    fresh = np.arange(len(x))
    for at in range(0, x.shape[1], probes):
        u, v = x[fresh, at : at + probes], y[fresh, at : at + probes]
        same = u[:, :, None] == v[:, None, :]
        earlier = (same & (u < bucket)[:, :, None]).any(axis=(1, 2))
        fresh = fresh[~earlier]
        if (u[:1] >= bucket).all() or not len(fresh):
            break
    return fresh


def _block_pair(bucket, same, left, right, cosine, probes):
    """(ids, links, roots) of one pair of blocks: links counted, and a forest of them."""
    (ia, na, a, ca), (ib, nb, b, cb) = left, right
    hit = (a @ b.T) >= cosine
    if same:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    if not len(i):
        return None
    fresh = []
    for at in range(0, len(i), 1 << 14):
        u, v = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        fresh.append(at + _new_in(ca[u], cb[v], bucket, probes))
    fresh = np.concatenate(fresh)
    i, j = i[fresh], j[fresh]
    names, at = np.unique(np.concatenate((ia[i], ib[j])), return_inverse=True)
    links = np.zeros(len(names), np.int64)
    np.add.at(links, at, np.concatenate((nb[j], na[i])))
    root = smallest_labels(len(names), at[: len(i)], at[len(i) :])
    return names, links, names[root]


def _verify(cosine, probes):
    """Rows sorted by bucket, block pair and side -> counts and forests of links."""

    def run(batches):
        for rows, edges in whole_groups(batches, ("bucket", "x", "y")):
            bucket, x, y, side, ids, copies = (rows.column(c).to_numpy() for c in ("bucket", "x", "y", "side", "id", "copies"))
            unit, codes = (rows.column(c).chunk(0) for c in ("unit", "codes"))
            size = unit.value_lengths().to_numpy(zero_copy_only=False)
            values = unit.flatten().to_numpy()
            start = np.cumsum(size) - size
            code = codes.flatten().to_numpy().reshape(len(ids), -1)
            out = []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                # buckets hold vectors of one length, but for lengths equal modulo 4096
                for n in {int(size[s])} if size[s] == size[e - 1] and (size[s:e] == size[s]).all() else set(size[s:e].tolist()):
                    own = s + np.flatnonzero(size[s:e] == n)
                    vectors = values[start[own][:, None] + np.arange(n)]
                    parts = []
                    for k in (0, 1):
                        m = side[own] == k
                        parts.append((ids[own[m]], copies[own[m]], vectors[m], code[own[m]]))
                    same = bool(x[s] == y[s])
                    if len(parts[0][0]) and (same or len(parts[1][0])):
                        got = _block_pair(bucket[s], same, parts[0], parts[0] if same else parts[1], cosine, probes)
                        if got:
                            out.append(got)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["id", "links", "root"])

    return run


def linked(vectors, vec_id="vec_id", embedding="embedding", cosine=COSINE, block=BLOCK):
    """``vec_id, n_links, component_id``: one row per row of ``vectors``."""
    values = F.transform(embedding, lambda v: v.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    plain = vectors.select(F.col(vec_id).cast("long").alias("id"), values.alias("v"))
    fit = plain.where(F.col("id").isNotNull() & fine)
    # -0.0 and 0.0 are equal components
    key = F.sha2(F.array_join(F.transform("v", lambda x: (x + F.lit(0.0)).cast("string")), ","), 256)
    of = fit.select("id", key.alias("same"), "v").dropDuplicates(["id", "same"])
    owner = of.groupBy("same").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    rep = of.join(owner, (of["id"] == owner["rep"]) & (of["same"] == owner["same"])).select("id", "v", "copies")
    hashed = staged(rep.select("id", "v").mapInArrow(_hashed, "id long, unit array<double>, codes array<long>"), "hashed")
    hashed = hashed.join(rep.select("id", "copies"), "id")
    place = F.explode(F.array_distinct("codes")).alias("bucket")
    entry = hashed.select("id", place)
    many = entry.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    entry = entry.join(many, "bucket")
    entry = entry.withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int")).drop("size")
    entry = paired_blocks(entry, "bucket", "id")
    entry = entry.join(hashed, "id")
    order = ["bucket", "x", "y", "side"]
    parts = entry.repartition("bucket", "x", "y").sortWithinPartitions(*order)
    parts = parts.select(*order, "id", "copies", "unit", "codes")
    per_table = 1 + AXES * (PROBES - 1)
    found = staged(parts.mapInArrow(_verify(cosine, per_table), "id long, links long, root long"), "cosines")
    count = found.groupBy("id").agg(F.sum("links").alias("links"))
    label = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_rep = owner.join(count, owner["rep"] == count["id"], "left").drop("id")
    by_rep = by_rep.join(label, owner["rep"] == label["node"], "left")
    by_rep = by_rep.select(
        "same",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return (
        plain.withColumn("same", F.when(F.col("id").isNotNull() & fine, key))
        .join(by_rep, "same", "left")
        .select(
            F.col("id").alias("vec_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )


SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0
  AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r AS (SELECT a, a AS b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@register("op6_cross_polytope", SQL)
def op6_cross_polytope(spark, folder):
    out = linked(table(spark, folder, "embeddings"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
