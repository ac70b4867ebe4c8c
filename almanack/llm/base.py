"""Queries of this subpackage, and helpers that several operators share."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.sources.sinks import staged  # noqa: F401

QUERIES = {}
ORACLES = {}

#: white space that separates words, as a Java and RE2 class
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def register(name, sql=None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df, wanted):
    """``wanted``, or with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def packed(df, *needed):
    """``df`` with its columns as one, ``_doc``, so that none clashes with a working column;
    those ``needed`` stand beside it.  ``select("_doc.*")`` gives the columns back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"), *needed)


def holds_map(kind):
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and holds_map(kind.elementType)


def row_hash(df):
    """A hash of all columns; those that hold maps, which have no hash, as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(f"`{f.name}`")) if holds_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def all_of(conditions):
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def paired_blocks(entries, key, item):
    """Rows of a group with ``blocks``, dealt by hash over its blocks, for the comparison of
    every block with itself and each later one: ``x, y`` name the pair of blocks and
    ``side`` (0 or 1) the one the row is in.  A row is there once for each block."""
    dealt = entries.withColumn("_own", F.pmod(F.xxhash64(item, key), F.col("blocks")).cast("int"))
    own = F.col("_own")
    left = F.transform(F.sequence(own, F.col("blocks") - 1), lambda o: F.struct(own.alias("x"), o.alias("y"), F.lit(0).alias("side")))
    right = F.transform(F.sequence(F.lit(0), own), lambda o: F.struct(o.alias("x"), own.alias("y"), F.lit(1).alias("side")))
    meet = F.filter(F.concat(left, right), lambda s: (s["side"] == 0) | (s["x"] != s["y"]))
    return dealt.withColumn("_meet", F.explode(meet)).select("*", "_meet.*").drop("_own", "_meet", "blocks")


def whole_groups(batches, keys):
    """Arrow tables with the bounds of their groups, from rows sorted by ``keys``: a group
    that runs into the next batch waits for it."""
    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        values = [rest.column(c).to_numpy() for c in keys]
        edge = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        if len(edge):
            yield rest.slice(0, edge[-1]).combine_chunks(), np.concatenate(([0], edge))
            rest = rest.slice(edge[-1])
    if rest is not None and len(rest):
        yield rest.combine_chunks(), np.array([0, len(rest)])


def smallest_labels(size, u, v):
    """The smallest node reachable from each of ``size`` nodes by the links ``u - v``."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            return root
