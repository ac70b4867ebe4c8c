"""Vectors for operators that compare a stated query set with every row.

Rows are dealt by a hash of their id into shards that fit in a task; every query visits
every shard, and what a shard finds is merged by query.  So no task sees a whole table
and no pair of rows is written but the best of a shard.

An id that is there several times stands for one row, the one whose values come first in
array order.
"""

import numpy as np
from pyspark.sql import functions as F

#: components a shard holds on average, and the least number of shards
SHARD_VALUES = 1 << 22
LEAST_SHARDS = 16
#: entries of a matrix of queries and rows that is worked on at a time
AT_ONCE = 1 << 20


def usable(df, vec_id, embedding, **more):
    """``id``, ``v`` (doubles) and ``more`` of the rows that have an id and a vector
    without missing or non-finite components."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    columns = [c.alias(name) for name, c in more.items()]
    values = F.transform(F.col(embedding), lambda x: x.cast("double"))
    return df.select(F.col(vec_id).cast("long").alias("id"), values.alias("v"), *columns).where(F.col("id").isNotNull() & whole)


def one_per_id(df):
    """Of the rows of an id the first in the order of the other columns."""
    rest = [c for c in df.columns if c != "id"]
    return df.groupBy("id").agg(F.min(F.struct(*rest)).alias("_r")).select("id", "_r.*")


def shard_count(points):
    values = points.agg(F.sum(F.size("v"))).first()[0] or 0
    return max(LEAST_SHARDS, -(-values // SHARD_VALUES))


def in_shards(points, shards):
    return points.withColumns({"size": F.size("v"), "shard": F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")})


def in_every_shard(queries, shards):
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    return queries.withColumns({"size": F.size("v"), "shard": everywhere})


def meeting(rows, queries, shards):
    """Each shard's rows in one task, before the queries that visit it."""
    both = rows.withColumn("asks", F.lit(0)).unionByName(queries.withColumn("asks", F.lit(1)), allowMissingColumns=True)
    return both.repartition(2 * shards, "size", "shard").sortWithinPartitions("size", "shard", "asks")


def matrix(column, size):
    """A list column whose lists all have ``size`` values as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def visits(batches):
    """``(size, rows, queries)`` for each batch of queries of a shard, from what
    ``meeting`` gives: ``rows`` is a list of the shard's record batches, the same object
    for all its queries."""
    key, rows = None, []
    for batch in batches:
        names = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("size", "shard", "asks")]
        edge = np.flatnonzero(np.any([v[1:] != v[:-1] for v in names], axis=0)) + 1
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
            if s == e:
                continue
            size, shard, asks = (int(v[s]) for v in names)
            if (size, shard) != key:
                key, rows = (size, shard), []
            if not asks:
                rows.append(batch.slice(s, e - s))
            elif rows:
                yield size, rows, batch.slice(s, e - s)


def first_of_each(row, order, k):
    """Places of the first ``k`` of every ``row`` by the keys ``order``, most telling
    first, and their ranks from 0."""
    at = np.lexsort((*order[::-1], row))
    sorted_rows = row[at]
    starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]]) if len(at) else np.zeros(0, int)
    rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    return at[rank < k], rank[rank < k]
