"""Extra columns that are named like working columns, or hold maps, keep their values."""

import gzip

import pytest
from pyspark.sql import functions as F

from almanack.llm import warc
from almanack.llm.bag_minhash import keep_one
from almanack.llm.decontaminate import clean, find_occurrences
from almanack.llm.html_extract import extract
from almanack.llm.line_dedup import dedup_lines
from almanack.llm.mix import mix
from almanack.llm.shard import shuffled

NAMES = ["_row", "_hash", "_keep", "_key", "_rank", "_own", "_times", "_doc", "_lines", "_gone", "_text", "_bucket", "hit_spans"]
ITEM = "a b c d e f g h i j"
OPERATORS = {
    "dedup_lines": dedup_lines,
    "extract": lambda d: extract(d.withColumn("url", F.lit("http://a/")).withColumnRenamed("text", "html")).withColumnRenamed("html", "text"),
    "keep_one": keep_one,
    "shuffled": shuffled,
    "mix": mix,
    "clean": lambda d: clean(d, d.sparkSession.createDataFrame([("i", ITEM)], "item_id string, text string")),
}


def frame(spark):
    docs = spark.createDataFrame(
        [(1, "one two three\nfour", "s"), (2, "five six", "s"), (3, None, None), (None, "seven", "t"), (4, "", "t"), (2, "five six", "s")],
        "doc_id long, text string, source string",
    )
    marks = {n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES}
    return docs.withColumns(marks).withColumn("tags", F.create_map(F.lit("k"), F.col("source")))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_named_like_working_ones_keep_their_values(spark, name):
    docs = frame(spark)
    got = OPERATORS[name](docs).collect()
    assert {r.doc_id for r in got} >= {1, 2, None}
    for r in got:
        mark = "-" if r.doc_id is None else str(r.doc_id)
        assert all(r[n] == n + mark for n in NAMES)
        assert r.tags == {"k": {1: "s", 2: "s", None: "t", 3: None, 4: "t"}[r.doc_id]}
    assert OPERATORS[name](docs.limit(0)).count() == 0


def test_benchmark_blocks_follow_the_words_searched_for(spark):
    """Items without spaces are dealt over blocks as others are, and found in every one."""
    items = spark.createDataFrame([(f"i{k}", ",".join(f"w{k}x{j}" for j in range(12))) for k in range(20)], "item_id string, text string")
    docs = items.select(F.expr("CAST(substring(item_id, 2) AS LONG)").alias("doc_id"), F.upper("text").alias("text"))
    whole, dealt = (find_occurrences(docs, items, block_words=b).orderBy("doc_id").collect() for b in (10_000, 30))
    assert whole == dealt and all(r.hit_items == [f"i{r.doc_id}"] and r.hit_spans == [[0, 12]] for r in dealt)


def test_warc_versions_packing_and_charsets(spark, tmp_path):
    def record(version, name, block):
        return f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    plain = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>one</p>"
    (tmp_path / "a.warc").write_bytes(record("1.0", "<a>", plain) + record("1.1", "<b>", plain))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("1.1", "<c>", plain)) + gzip.compress(record("1.1", "<d>", plain)))
    rows = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted(r.headers["WARC-Record-ID"] for r in rows) == ["<a>", "<b>", "<c>", "<d>"]
    assert all(r.complete and bytes(r.block) == plain for r in rows)

    def text(head, payload):
        return warc.derive({}, f"HTTP/1.1 200 OK\r\n{head}\r\n\r\n".encode() + payload)[1][1]

    page = "<p>café</p>"
    assert text("content-type: text/html; charset=ISO-8859-1", page.encode("latin-1")) == "café"
    assert text("Content-Encoding: gzip\r\nContent-Type: text/html", gzip.compress(page.encode())) == "café"
    assert text("Content-Encoding: gzip", page.encode()) == "café"
    assert text("Content-Type: text/html; charset=nowhere", page.encode()) == "café"
