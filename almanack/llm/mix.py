"""Mixing sources to target weights.

Every row gets a hash-random key.  A source's rows in the order of their keys are its
order of drawing; the key's leading bits are a range, so the order is a range sort.
Sizes are summed per source and range, ranges are summed within coarse ranges and
those within the source, and a window inside one range finishes the prefix sum: no
task needs more than one range of a source.  A source whose budget exceeds it is
repeated whole for each full epoch, and the last epoch is cut where the budget ends.

The cut falls between rows: the row that straddles the budget is taken when at least
half of it fits, so a source misses its target by at most half a row.

Defined results: a null text has size 0 and is never taken; a null source is a source
of its own, last in order; rows with equal ids are drawn in order of their text's hash,
equal rows are interchangeable; a source without words has target 0; without any words
nothing is taken; other columns pass through.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanack.llm.base import NOT_SPACE, packed, register, row_hash, staged, table

CAP = 3
WEIGHTS = (1, 2, 3)
RANGE_ROWS = 4096
LEAST_RANGES = 256


def words_of(text):
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def targets(sizes, weights=WEIGHTS, cap=CAP):
    """``source, source_size`` -> also ``target``: shares of the total by weight, never
    above ``cap`` times the source; what is above goes to the others by weight.

    With sources in order of cap/weight, the first k are at their cap, for the least k at
    which the remaining total per weight does not exceed the next one's cap per weight.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ratio = W.orderBy("ratio", "place")
    done = ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    everyone = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    choice = F.array(*[F.lit(float(w)) for w in weights])
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(done), F.lit(0))) / F.sum("weight").over(rest)
    free = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everyone)
    return (
        sizes.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(choice, F.pmod("place", F.lit(len(weights)))))
        .withColumn("limit", F.col("source_size") * cap)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", free["level"])
        .withColumn("target", F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def prefix_sums(rows, group, key, tie, value, ranges, out, per_group):
    """``rows`` with ``out``, the sum of ``value`` over the rows of their ``group`` that
    come earlier by ``key`` and ``tie``, and with the columns of ``per_group``.

    ``key`` is uniform over the numbers of 60 bits.  ``ranges`` is the square of a power
    of two; no window holds more than its root of range sums, or one range of rows.  The
    group is compared as a struct, in which null equals null.
    """
    side = int(round(ranges**0.5))
    rows = rows.withColumn("_group", F.struct(group)).withColumn("_range", F.expr(f"CAST({key} DIV {(1 << 60) // ranges} AS INT)"))
    rows = rows.withColumn("_coarse", F.expr(f"CAST(_range DIV {side} AS INT)"))
    before = lambda *part: W.partitionBy(*part[:-1]).orderBy(part[-1]).rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    fine = rows.groupBy("_group", "_coarse", "_range").agg(F.sum(value).alias("_sum"))
    coarse = fine.groupBy("_group", "_coarse").agg(F.sum("_sum").alias("_sum"))
    coarse = coarse.select("_group", "_coarse", F.coalesce(F.sum("_sum").over(before("_group", "_coarse")), none).alias("_earlier"))
    in_coarse = F.coalesce(F.sum("_sum").over(before("_group", "_coarse", "_range")), none)
    start = fine.select("_group", "_coarse", "_range", in_coarse.alias("_in")).join(coarse, ["_group", "_coarse"])
    start = start.join(per_group.withColumn("_group", F.struct(group)).drop(group), "_group")
    start = start.withColumn("_start", F.col("_earlier") + F.col("_in")).drop("_earlier", "_in", "_coarse")
    inside = W.partitionBy("_group", "_range").orderBy(key, *tie).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), none)).drop("_coarse")
    rows = rows.join(start, ["_group", "_range"])
    return rows.withColumn(out, F.col("_start") + F.col("_inside")).drop("_group", "_range", "_start", "_inside")


def range_count(rows):
    """Ranges of about ``RANGE_ROWS`` rows, as a square of a power of two."""
    count = LEAST_RANGES
    while count * RANGE_ROWS < rows:
        count *= 4
    return count


def mixed_sizes(docs, seed="mix", weights=WEIGHTS, cap=CAP):
    """One row per row of ``docs``: doc_id, source, ``row_hash`` (of all its columns), size,
    its source's size and target, and ``taken``, its words in the mix with repeats."""
    # the key is the md5 of seed and id, so that SQL elsewhere gives the same order
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = staged(
        docs.select(
            "doc_id",
            "source",
            row_hash(docs).alias("row_hash"),
            words_of(F.col("text")).alias("size"),
            F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("_key"),
        ),
        "mix",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, cap)
    rows = prefix_sums(rows, "source", "_key", ["doc_id", "row_hash"], "size", range_count(rows.count()), "_before", goal)
    budget = F.round("target").cast("long")
    whole = F.greatest("source_size", F.lit(1))
    fits = F.col("_before") * 2 + F.col("size") <= F.col("_last") * 2
    return (
        rows.withColumn("_budget", budget)
        .withColumn("_whole", whole)
        .withColumn("_last", F.expr("_budget % _whole"))
        .withColumn("taken", F.col("size") * (F.expr("_budget DIV _whole") + F.when(fits, 1).otherwise(0)))
        .drop("_budget", "_whole", "_last", "_before", "_key")
    )


def mix(docs, **options):
    """``docs``, each row repeated as often as the mix takes it; columns unchanged.

    Rows that are equal in all columns share their times evenly.
    """
    times = F.when(F.col("size") > 0, F.expr("taken DIV size")).otherwise(0)
    plan = mixed_sizes(docs, **options).groupBy("doc_id", "source", "row_hash")
    plan = plan.agg(F.sum(times).alias("_times"), F.count("*").alias("_rows")).where("_times > 0")
    plan = plan.select(F.struct("doc_id", "source", "row_hash").alias("_row"), "_times", "_rows")
    rows = packed(docs, F.struct("doc_id", "source", row_hash(docs).alias("row_hash")).alias("_row")).join(plan, "_row")
    rank = F.when(F.col("_rows") > 1, F.row_number().over(W.partitionBy("_row").orderBy(F.lit(0)))).otherwise(1)
    own = F.expr("_times DIV _rows") + F.when(F.col("_rank") <= F.expr("_times % _rows"), 1).otherwise(0)
    rows = rows.withColumn("_rank", rank).withColumn("_own", own).where("_own > 0")
    return rows.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "_own"))).select("_doc.*")


SIZE = r"CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END"

SQL = f"""
WITH d AS (SELECT doc_id, source, CAST({SIZE} AS BIGINT) AS size, md5('mix|' || doc_id) AS key, text FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1.0::DOUBLE, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
r AS (SELECT *, {CAP} * source_size AS cap, {CAP} * source_size / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio LIMIT 1),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), f.level * weight) AS target FROM l, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY substr(key, 1, 15), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (budget // greatest(source_size, 1)
  + CASE WHEN 2 * before + size <= 2 * (budget % greatest(source_size, 1)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM p
"""


@register("op9_mix_sources", SQL)
def op9_mix_sources(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixed_sizes(docs).select("doc_id", "size", "source_size", "target", "taken")
