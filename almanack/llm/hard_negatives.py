"""Hard negatives of each positive, by slots between the positives' scores.

An anchor's positives are its best rows of the same label; their scores are the upper
limits of windows in which negatives are looked for.  The limits cut the scores below
the best positive into disjoint slots: slot ``i`` lies above limit ``i + 1`` and not
above limit ``i``, so window ``i`` is the slots from ``i`` on.  Every task keeps the best
``k`` of a slot among its rows, these are combined per anchor and slot, and merges from the
lowest slot up give the best ``k`` below every limit at once; the windows' lower limits
cut what is left.

Scores are inner products of whole numbers, exact.  Anchors visit all shards twice, once
for positives and once for negatives; anchors and rows are never paired outside a task.

Defined results: rows without an id or label and vectors that are null or hold null or
non-finite components take no part; only vectors of one length are scored; an id that is
there several times stands for one row (``vectors``); an anchor without positives, and a
positive without negatives in its window, give no row; a negative positive score has an
empty window; scores outside the range of long are its ends; an empty table gives no
rows; other columns are left.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from almanack.llm import vectors as V
from almanack.llm.base import register, staged, table

POSITIVES, NEGATIVES = 5, 5
EVERY, MOVED, LABELS = 100, 7, 10
SCALE = 256
LOW = 80  # percent of the positive's score
ENDS = np.iinfo(np.int64)


def scores(a, x):
    """Exact inner products of rows of ``a`` and ``x``."""
    top = a.shape[1] * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0))
    if top < 2 ** 53:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    return np.clip(a.astype(object) @ x.astype(object).T, ENDS.min, ENDS.max).astype(np.int64)


def _rows(batches, size):
    """Ids, labels and vectors of a shard."""
    column = lambda c: [b.column(b.schema.get_field_index(c)) for b in batches]
    ids, labels = (np.concatenate([p.to_numpy() for p in column(c)]) for c in ("id", "label"))
    return ids, labels, np.concatenate([V.matrix(p, size) for p in column("v")])


def _visited(pick):
    """``pick(asked, anchors' labels, ids of rows, labels, scores)`` gives (row, column,
    further key, count) of what may be kept, for some anchors at a time."""

    def run(batches):
        of = None
        for size, rows, asked in V.visits(batches):
            if of is not rows:
                of = rows
                ids, labels, x = _rows(rows, size)
            anchors, kinds, a = _rows([asked], size)
            step = max(1, V.AT_ONCE // len(ids))
            for at in range(0, len(anchors), step):
                part = slice(at, at + step)
                s = scores(a[part], x)
                row, column, slot, count = pick(asked.slice(at, step), anchors[part], kinds[part], ids, labels, s)
                score = s[row, column]
                first, _ = V.first_of_each(row * (slot.max(initial=0) + 1) + slot, (~score, ids[column]), count)
                row, column = row[first], column[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[part][row]), pa.array(slot[first].astype(np.int32)), pa.array(ids[column]), pa.array(score[first])],
                    names=["anchor_id", "slot", "id", "score"],
                )

    return run


FOUND = "anchor_id long, slot int, id long, score long"


def _positives(count):
    def pick(asked, anchors, kinds, ids, labels, s):
        same = (labels == kinds[:, None]) & (ids != anchors[:, None])
        if s.shape[1] > count:  # what lies below the count-th best is never kept
            masked = np.where(same, s, ENDS.min)
            same &= s >= np.partition(masked, -count, axis=1)[:, -count][:, None]
        row, column = np.nonzero(same)
        return row, column, np.zeros(len(row), int), count

    return _visited(pick)


def _slots(limits, s):
    """Of each score the number of limits not below it, less one."""
    return (limits[:, :, None] >= s[:, None, :]).sum(axis=1) - 1


def _negatives(count):
    def pick(asked, anchors, kinds, ids, labels, s):
        lists = asked.column(asked.schema.get_field_index("limits"))
        least = asked.column(asked.schema.get_field_index("least")).to_numpy()
        many = lists.value_lengths().to_numpy()
        # absent limits are never reached: scores at the end of long stand below them
        limits = np.full((len(anchors), many.max(initial=1)), ENDS.min)
        limits[np.arange(limits.shape[1]) < many[:, None]] = lists.flatten().to_numpy()
        other = (labels != kinds[:, None]) & (s >= least[:, None]) & (s <= limits[:, :1])
        row, column = np.nonzero(other)
        slot = _slots(limits[row], s[row, column][:, None])[:, 0]
        return row, column, np.minimum(slot, many[row] - 1), count

    return _visited(pick)


def _combined(found, count):
    """The best ``count`` of every anchor and slot over all shards."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def least_score(positive, low=LOW):
    """The lowest score in a positive's window."""
    wide = positive.cast("decimal(38,0)")
    return F.ceil(wide * F.lit(low) / F.lit(100)).cast("long")


def mined(points, anchors, positives=POSITIVES, negatives=NEGATIVES, low=LOW):
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from
    ``id, label, v`` (whole numbers) of all rows and of the anchors among them."""
    shards = V.shard_count(points)
    rows = V.in_shards(points, shards)
    asking = V.in_every_shard(anchors, shards)
    best = V.meeting(rows, asking, shards).mapInArrow(_positives(positives), FOUND)
    best = _combined(best, positives)
    # the anchor's positives in order, at most ``positives`` of them
    best = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    best = staged(best, "positives")
    limits = F.transform("best", lambda p: p["score"])
    # a window of a negative score is empty
    reach = F.filter(limits, lambda s: s >= 0)
    asking = anchors.join(best, anchors["id"] == best["anchor_id"]).where(F.size(reach) > 0)
    asking = asking.select("id", "label", "v", limits.alias("limits"), least_score(F.array_min(reach), low).alias("least"))
    asking = V.in_every_shard(asking, shards)
    found = V.meeting(rows, asking, shards).mapInArrow(_negatives(negatives), FOUND)
    kept = _combined(found, negatives).groupBy("anchor_id").agg(
        F.collect_list(F.struct((-F.col("score")).alias("below"), "id", "score", "slot")).alias("kept")
    )
    merged = best.join(kept, "anchor_id").withColumn(f"_m{positives}", F.slice("kept", 1, 0))
    for i in reversed(range(positives)):
        own = F.filter("kept", lambda n: n["slot"] == F.lit(i))  # noqa: B023
        merged = merged.withColumn(f"_m{i}", F.slice(F.array_sort(F.concat(own, f"_m{i + 1}")), 1, negatives))
    windows = F.array(*[F.col(f"_m{i}") for i in range(positives)])
    merged = merged.select("anchor_id", F.posexplode("best").alias("at", "p"), windows.alias("w"))
    inside = F.filter(F.expr("w[at]"), lambda n: (F.col("p.score") >= 0) & (n["score"] >= least_score(F.col("p.score"), low)))
    return merged.select("anchor_id", "p", F.posexplode(inside).alias("rank", "n")).select(
        "anchor_id", F.col("p.id").alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )


def whole_numbers(vectors, label, vec_id="vec_id", embedding="embedding", scale=SCALE):
    """``id, label, v``: components times ``scale``, rounded down, of the rows that take part."""
    rows = V.usable(vectors, vec_id, embedding, label=label.cast("long")).where("label IS NOT NULL")
    return V.one_per_id(rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale))).select("id", "label", "v"))


SQL = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    CASE WHEN vec_id % {MOVED} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS label FROM embeddings),
g AS (SELECT vec_id, label, [floor({SCALE} * x) FOR x IN e] AS e FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL
  AND e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM g a JOIN g b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id, score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r
  FROM s WHERE same) WHERE r <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}
"""


@register("op12_slot_negatives", SQL)
def op12_slot_negatives(spark, folder):
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label"))
    points = staged(whole_numbers(table(spark, folder, "embeddings"), moved), "whole-numbers")
    return mined(points, points.where(F.col("id") % EVERY == 0))
