"""Near-duplicate documents by BagMinHash.

A document is the multiset of its shingles of five words.  For every shingle and every
unit of its weight a Poisson process of points (time, register) is derived from hashes
alone; a register keeps the earliest time of all points, so two documents agree in a
register with probability equal to their weighted Jaccard similarity.  Weights are
dealt hierarchically: the ranges (0,1], (1,2], (2,4], (4,8] ... each have one process of
the summed rate, whose points are split by halves only where they still can matter.

Registers are cut into bands; documents that share a band are candidates, and each
candidate pair is decided by the exact overlap of its multisets.  Documents with the
same word sequence are one class from the start and take part once.  Inside a bucket
documents are compared with a few leaders, not with each other; components are joined
as links are found, and only buckets whose members still differ in component go on,
with other leaders.  Buckets that are open after the rounds of leaders are compared in
full, block by block inside tasks that give a spanning forest of links and no pairs, so
connections between any texts sharing a band are found.

Defined results: words are runs without white space, lower-cased in A-Z; a document of
fewer than five words is one shingle; documents without words (null, empty, blank) are
one class; ids should be unique, a repeated id with two texts joins their classes; rows
without an id get the class of their text (null if no such row has an id).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from almanack.llm.base import free_name, paired_blocks, register, staged, table, whole_groups
from almanack.llm.components import components
from almanack.llm.textbytes import SOLID, U, chunks, mixed, words

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
LEADERS, ROUNDS = 3, 2
BLOCK, BLOCK_SHINGLES = 256, 200_000
_K = U(0x9E3779B97F4A7C15)


def shingles(h, at, width=WIDTH):
    """(hash of each shingle, offsets by row); a shorter row with words is one shingle."""
    count = np.diff(at)
    many = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_at = np.concatenate(([0], np.cumsum(many)))
    start = np.arange(out_at[-1]) - np.repeat(out_at[:-1], many) + np.repeat(at[:-1], many)
    size = np.repeat(np.minimum(count, width), many)
    out = np.zeros(len(start), U)
    for k in range(width):
        live = size > k
        if live.all():
            out = mixed(out * _K + h[start + k])
        else:
            out[live] = mixed(out[live] * _K + h[start[live] + k])
    return out, out_at


def _uniform(x):
    return ((x >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(keys, at, registers):
    """BagMinHash of each row's multiset of ``keys``: an array rows by registers."""
    rows = len(at) - 1
    best = np.full((rows, registers), np.inf)
    flat = best.ravel()
    row = np.repeat(np.arange(rows), np.diff(at))
    order = np.lexsort((keys, row))
    key, row = keys[order], row[order]
    edge = np.ones(len(key), bool)
    edge[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(edge)
    weight = np.diff(np.append(starts, len(key)))
    key, row = key[starts], row[starts]
    # roots (0,1], (1,2], (2,4] ...: as many as reach the weight
    roots = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    level = np.arange(int(roots.sum())) - np.repeat(np.cumsum(roots) - roots, roots)
    row, weight = np.repeat(row, roots), np.repeat(weight, roots)
    state = mixed(np.repeat(key, roots) + level.astype(U) * _K + U(1))
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    span = np.where(level == 0, 1, low)
    time = -np.log(_uniform(state)) / span
    bound = np.full(rows, np.inf)
    while len(row):
        leaf = span == 1
        # points of unit ranges: the present one, and more when few processes are left
        if leaf.any():
            r, s, t = row[leaf], state[leaf], time[leaf]
            extra = int(np.clip(8192 // max(1, len(r)), 1, 64))
            states, gaps = [s], [t]
            for _ in range(extra):
                s = mixed(s + _K)
                states.append(s)
                gaps.append(-np.log(_uniform(s)))
            times = np.cumsum(np.stack(gaps), axis=0)
            slots = (mixed(np.stack(states[:-1]) ^ U(0xD6E8FEB86659FD93)) % U(registers)).astype(np.int64)
            np.minimum.at(flat, (r * registers + slots).ravel(), times[:-1].ravel())
            touched = np.unique(r)
            bound[touched] = best[touched].max(axis=1)
            state[leaf], time[leaf] = s, times[-1]
        if not leaf.all():
            # the point of a wider range falls in one half; the other half waits anew
            w = ~leaf
            r, s, t, lo, sp, wt = row[w], state[w], time[w], low[w], span[w] // 2, weight[w]
            right = (mixed(s ^ U(0xA0761D6478BD642F)) & U(1)).astype(bool)
            a, b = mixed(s + _K), mixed(s + _K + _K)
            late_a, late_b = t - np.log(_uniform(a)) / sp, t - np.log(_uniform(b)) / sp
            row = np.concatenate((row[leaf], r, r))
            state = np.concatenate((state[leaf], a, b))
            time = np.concatenate((time[leaf], np.where(right, late_a, t), np.where(right, t, late_b)))
            low = np.concatenate((low[leaf], lo, lo + sp))
            span = np.concatenate((span[leaf], sp, sp))
            weight = np.concatenate((weight[leaf], wt, wt))
        keep = (time <= bound[row]) & (low < weight)
        row, state, time, low, span, weight = (v[keep] for v in (row, state, time, low, span, weight))
    return best


def band_keys(best, bands=BANDS):
    """A hash for each row and band."""
    bits = best.view(U).reshape(len(best), bands, -1)
    out = np.broadcast_to(np.arange(bands, dtype=U), bits.shape[:2]).copy()
    for k in range(bits.shape[2]):
        out = mixed(out * _K + bits[:, :, k])
    return out


def _sequence_hash(h, at, salt):
    """An order-aware hash of each row's words."""
    place = np.arange(len(h)) - np.repeat(at[:-1], np.diff(at))
    v = np.concatenate((mixed(h ^ mixed(place.astype(U) * _K + U(salt))), np.zeros(1, U)))
    total = np.cumsum(v) - v
    return mixed(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(U))


def signed(docs, doc_id="doc_id", text="text", width=WIDTH, bands=BANDS, rows=ROWS):
    """``doc_id, c1, c2`` (the word sequence), ``n`` shingles, ``bands`` (none without words)."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, last, x, at in chunks(texts):
                h, of_row = words(x, at, SOLID)
                s, of_shingle = shingles(h, of_row, width)
                keys = band_keys(signatures(s, of_shingle, bands * rows), bands)
                count = np.diff(of_shingle)
                sizes = np.where(count > 0, bands, 0)
                lists = pa.ListArray.from_arrays(
                    np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), keys[count > 0].ravel().view(np.int64)
                )
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first)]
                    + [pa.array(_sequence_hash(h, of_row, k).view(np.int64)) for k in (1, 2)]
                    + [pa.array(count.astype(np.int64)), lists],
                    names=["doc_id", "c1", "c2", "n", "bands"],
                )

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, c1 long, c2 long, n long, bands array<long>")


def bags(docs, width=WIDTH):
    """``doc_id, text`` -> ``doc_id, bag``: the sorted shingle hashes, with repeats."""

    def run(batches):
        for batch in batches:
            for first, last, x, at in chunks(batch.column(1)):
                s, of = shingles(*words(x, at, SOLID), width)
                row = np.repeat(np.arange(last - first), np.diff(of))
                s = s[np.lexsort((s, row))]
                lists = pa.ListArray.from_arrays(of.astype(np.int32), s.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], names=["doc_id", "bag"])

    return docs.mapInArrow(run, "doc_id long, bag array<long>")


def overlap(a, b):
    """The size of the common part of two sorted multisets."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[i], cb[j]).sum())


def _linked(pairs, bag, similarity):
    """Those of ``a, b`` whose multisets overlap enough; each bag is sent once a pair."""

    def run(batches):
        for batch in batches:
            one, two = batch.column(2), batch.column(3)
            good = []
            for i in range(batch.num_rows):
                a, b = (c[i].values.to_numpy(zero_copy_only=False) for c in (one, two))
                common = overlap(a, b)
                good.append(common >= similarity * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = bag.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a"))
    right = bag.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "bag_a", "bag_b")
    return both.mapInArrow(run, "a long, b long")


def _overlaps(bags, left, right):
    """Overlap of each of the rows ``left`` with each of ``right``; bags of 32-bit hashes."""
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    value = np.concatenate(bags).view(np.uint32) if len(row) else np.zeros(0, np.uint32)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    nth = np.arange(len(value)) - np.repeat(start, np.diff(np.append(start, len(value))))
    # the k-th copy of a shingle is an element of its own, so overlaps are inner products
    _, column, many = np.unique((value.astype(U) << U(32)) | nth.astype(U), return_inverse=True, return_counts=True)
    seat = np.cumsum(many > 1) - 1
    shared = many[column] > 1
    row, column = row[shared], seat[column[shared]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (first, first + 4096))
        part = np.zeros((len(bags), 4096), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        out += part[left] @ part[right].T
    return out


def _forest(similarity):
    """Rows sorted by bucket, block pair and side -> links that join different components."""

    def run(batches):
        for rows, edges in whole_groups(batches, ("key", "x", "y")):
            x, y, side, ids, part, n = (rows.column(c).to_numpy() for c in ("x", "y", "side", "rep", "component", "n"))
            lists = rows.column("bag").chunk(0)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            one, two = [], []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                left = np.flatnonzero(side[s:e] == 0)
                right = left if x[s] == y[s] else np.flatnonzero(side[s:e] == 1)
                own = part[s:e]
                if not len(left) or not len(right) or (own == own[0]).all():
                    continue
                common = _overlaps([values[at[k] : at[k + 1]] for k in range(s, e)], left, right)
                size = n[s:e].astype(np.float64)
                union = size[left][:, None] + size[right][None, :] - common
                i, j = np.nonzero((common >= similarity * union) & (own[left][:, None] != own[right][None, :]))
                if len(i):
                    u, v = left[i], right[j]
                    u, v = _tree(e - s, u, v)
                    one.append(ids[s + u])
                    two.append(ids[s + v])
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(one)), pa.array(np.concatenate(two))], names=["a", "b"])

    return run


def _tree(size, u, v):
    """Links out of ``u - v`` that join the same nodes without a circle."""
    root = np.arange(size)

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    keep = []
    for at, (a, b) in enumerate(zip(u.tolist(), v.tolist())):
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            keep.append(at)
    return u[keep], v[keep]


def _open_members(member, found):
    """Members with their components, of the buckets that hold more than one component."""
    if found is None:
        live = member.withColumn("component", F.col("rep"))
    else:
        live = member.join(found.withColumnRenamed("node", "rep"), "rep", "left")
        live = live.withColumn("component", F.coalesce("component", "rep"))
    spread = live.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), F.sum("n").alias("total")
    )
    return live.join(spread.where("low < high").drop("low", "high"), "key")


def _with_leaders(live, turn, similarity):
    """Pairs of members and leaders that differ in component and may be similar."""
    draw = [F.xxhash64(F.lit(turn * LEADERS + k), "rep") for k in range(LEADERS)]
    who = F.struct("rep", "component", "n")
    leaders = live.groupBy("key").agg(*[F.min_by(who, d).alias(f"l{k}") for k, d in enumerate(draw)])
    leaders = leaders.select("key", F.explode(F.array_distinct(F.array(*[f"l{k}" for k in range(LEADERS)]))).alias("l"))
    leaders = leaders.select("key", F.col("l.rep").alias("other"), F.col("l.component").alias("of"), F.col("l.n").alias("size_of"))
    near = (F.least("n", "size_of") >= similarity * F.greatest("n", "size_of")) & (F.col("component") != F.col("of"))
    pairs = live.join(leaders, "key").where(near)
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _between_blocks(live, bag, similarity):
    """Links between components inside open buckets, a forest per pair of blocks."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    entries = paired_blocks(live.withColumn("blocks", blocks).drop("size", "total"), "key", "rep")
    short = F.transform("bag", lambda v: F.shiftright(F.shiftleft(v, 32), 32).cast("int"))
    entries = entries.join(bag.select(F.col("doc_id").alias("rep"), short.alias("bag")), "rep")
    entries = entries.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side")
    entries = entries.select("key", "x", "y", "side", "rep", "component", "n", "bag")
    return entries.mapInArrow(_forest(similarity), "a long, b long").distinct()


def classes(docs, doc_id="doc_id", text="text", similarity=SIMILARITY, width=WIDTH, bands=BANDS, rows=ROWS):
    """``doc_id, c1, c2, class_id``: one row per row of ``docs``."""
    sign = staged(signed(docs, doc_id, text, width, bands, rows), "signed")
    known = sign.where("doc_id IS NOT NULL").groupBy("c1", "c2")
    own = known.agg(F.min_by(F.struct("n", "bands"), "doc_id").alias("v"), F.min("doc_id").alias("rep"))
    member = own.select("rep", F.col("v.n").alias("n"), F.explode("v.bands").alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("many")).where("many > 1").drop("many")
    member = staged(member.join(shared, "key"), "members")
    involved = member.select(F.col("rep").alias("doc_id")).distinct()
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bag = staged(bags(source.join(involved, "doc_id"), width).dropDuplicates(["doc_id"]), "bags")

    links = found = None
    for turn in range(ROUNDS):
        pairs = staged(_with_leaders(_open_members(member, found), turn, similarity), "pairs")
        new = _linked(pairs, bag, similarity)
        links = staged(new if links is None else links.union(new), "linked")
        found = components(links)
    more = staged(_between_blocks(_open_members(member, found), bag, similarity), "linked")
    if not more.isEmpty():
        # 32 bits of hash have chosen them, all 64 decide
        found = components(links.union(_linked(more, bag, similarity)))
    label = known.agg(F.min("doc_id").alias("rep")).join(found.withColumnRenamed("node", "rep"), "rep", "left")
    label = label.select("c1", "c2", F.coalesce("component", "rep").alias("class_id"))
    return sign.select("doc_id", "c1", "c2").join(label, ["c1", "c2"], "left")


def keep_one(docs, **options):
    """``docs`` with the row of the smallest id of each class; columns unchanged.

    Rows without an id stay; of rows that repeat the id that stays, one stays.
    """
    label = classes(docs, **options)
    keep = free_name(docs, "_keep")
    first = label.where("doc_id = class_id").select(F.col("class_id").alias(keep)).distinct()
    keyed = docs.where("doc_id IS NOT NULL").join(first, F.col("doc_id") == F.col(keep)).drop(keep)
    keyed = keyed.dropDuplicates(["doc_id"])
    return keyed.unionByName(docs.where("doc_id IS NULL"))


@register("op3_bag_minhash")
def op3_bag_minhash(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    label = classes(docs)
    size = label.groupBy("class_id").agg(F.count("*").alias("class_size"))
    out = label.join(size, "class_id")
    return out.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))
