"""Sharding by a two-pass external shuffle.

Pass one scatters whole rows by a seeded hash into buckets that fit in memory; pass
two shuffles each bucket (Spark's ``shuffle`` is a seeded Fisher-Yates) and writes it.
The shuffled buckets in order are one random order of all rows, cut into shards of
equal row counts: the law is ``rows``.

A bucket is a task: rows go to the task that their bucket names, so the seed and the
input alone decide the order, whatever the cluster.

The hash is of all columns and the row's rank among equal rows, so repeated or missing
ids fill no bucket.  Equal rows are interchangeable: they are counted, and their copies
made anew with ranks, in blocks of ``COPIES``.

Defined results: a null text has size 1 and the check sum of an empty text; with no rows
there are no shards; input columns pass through, those named like a result are
replaced.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanack.llm.base import holds_map, packed, register, row_hash, staged, table
from almanack.sources.sinks import staging_path

SHARDS = 16
SEED = 20_24
BUCKET_BYTES = 16 << 20
SIDE = 1024
COPIES = 4096


def size_of(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def bucket_starts(buckets, column="_bucket", count="_rows"):
    """Rows in earlier buckets, by two levels of prefix sums."""
    before = lambda part, by: W.partitionBy(part).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    coarse = F.expr(f"{column} DIV {SIDE}")
    fine = buckets.withColumn("_coarse", coarse)
    fine = fine.withColumn("_in", F.coalesce(F.sum(count).over(before("_coarse", column)), F.lit(0)))
    total = fine.groupBy("_coarse").agg(F.sum(count).alias("_sum"))
    total = total.withColumn("_at", F.coalesce(F.sum("_sum").over(before(F.lit(0), "_coarse")), F.lit(0)))
    return fine.join(total, "_coarse").select(column, (F.col("_in") + F.col("_at")).alias("_start"))


def ranked(docs):
    """``docs`` with ``_hash``, of all columns (or the one there is), and ``_rank``, from 0
    among equal rows."""
    hashed = docs if "_hash" in docs.columns else docs.withColumn("_hash", row_hash(docs))
    often = staged(hashed.groupBy("_hash").count().where("count > 1").select("_hash"), "repeated")
    if often.isEmpty():
        return hashed.withColumn("_rank", F.lit(0).cast("long"))
    once = hashed.join(often, "_hash", "left_anti").withColumn("_rank", F.lit(0).cast("long"))
    many = hashed.join(often, "_hash", "left_semi").groupBy(*hashed.columns).agg(F.count("*").alias("_times"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_times - 1) DIV {COPIES}")))
    many = many.withColumn("_block", block).repartition("_hash", "_block")
    first = F.col("_block") * COPIES
    copies = F.sequence(first, F.least(first + COPIES, F.col("_times")) - 1)
    return once.unionByName(many.withColumn("_rank", F.explode(copies)).drop("_times", "_block"))


def shuffled(docs, key="doc_id", text="text", shards=SHARDS, seed=SEED, bucket_bytes=BUCKET_BYTES):
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "slot")])
    rows, size = docs.agg(F.count("*"), F.sum(size_of(F.col(text)))).head()
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col("_hash"), F.col("_rank")), F.lit(buckets)).cast("int")
    dealt = ranked(packed(docs, row_hash(docs).alias("_hash"))).withColumn("_bucket", bucket).drop("_rank")
    starts = dealt.select("_bucket").groupBy("_bucket").agg(F.count("*").alias("_rows"))
    starts = bucket_starts(starts)
    record = F.col("_doc")
    order = F.xxhash64(F.lit(seed + 1), record[key], record[text])
    bucket_rows = F.collect_list(F.struct(order.alias("_order"), record.alias("_record")))
    in_order = F.array_sort(bucket_rows)
    if holds_map(dealt.schema):
        # maps have no order, so the whole row's hash stands for them
        bucket_rows = F.collect_list(F.struct(order.alias("_order"), record.alias("_record"), "_hash"))
        place_of = lambda r: F.struct(r["_order"], r["_hash"])
        in_order = F.array_sort(bucket_rows, lambda a, b: F.when(place_of(a) < place_of(b), -1).when(place_of(a) > place_of(b), 1).otherwise(0))
    mixed = (
        dealt.repartitionById(buckets, F.col("_bucket"))
        .groupBy("_bucket")
        .agg(in_order.alias("_rows"))
        .select("_bucket", F.posexplode(F.shuffle("_rows", seed)).alias("_place", "_row"))
    )
    place = F.col("_start") + F.col("_place")
    # shard s holds the places from ceil(s * rows / shards)
    first = F.expr(f"(CAST(shard AS LONG) * {rows} + {shards - 1}) DIV {shards}")
    return (
        mixed.join(F.broadcast(starts) if buckets <= 1 << 16 else starts, "_bucket")
        .withColumn("_at", place)
        .withColumn("shard", F.expr(f"CAST(_at * {shards} DIV {max(rows, 1)} AS INT)"))
        .withColumn("slot", F.col("_at") - first)
        .select("_row._record.*", "shard", "slot")
    )


def write_shards(docs, path, **options):
    """Write ``docs`` as one folder per shard, rows in the order of their slots."""
    shuffled(docs, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@register("op4_shard")
def op4_shard(spark, folder):
    """Law ``rows``; read back from the files that hold the whole shuffled rows."""
    path = staging_path(spark, "shards")
    write_shards(table(spark, folder, "documents"), path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return spark.read.parquet(path).select(
        "doc_id",
        size_of(F.col("text")).alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
