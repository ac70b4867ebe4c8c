"""Queries of the subpackage against their SQL, and their promises where SQL has none."""

import zlib

import pytest

from almanack.llm.registry import ORACLES, QUERIES
from tests.compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == []


def test_shards_hold_all_rows_once_and_evenly(spark, folder):
    rows = QUERIES["op4_shard"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_order_of_shards_is_not_the_order_of_ids(spark, folder):
    from almanack.llm.shard import shuffled

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = [r.doc_id for r in shuffled(docs).orderBy("shard", "slot").collect()]
    again = [r.doc_id for r in shuffled(docs.repartition(7)).orderBy("shard", "slot").collect()]
    other = [r.doc_id for r in shuffled(docs, seed=5).orderBy("shard", "slot").collect()]
    small = [r.doc_id for r in shuffled(docs, bucket_bytes=10_000).orderBy("shard", "slot").collect()]
    assert one == again and one != sorted(one) and one != other and one != small and sorted(small) == sorted(one)


def test_html_text_of_the_pages(spark, folder):
    import html
    import re

    for r in QUERIES["op2_html_text"](spark, folder).join(
        spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]+>", " ", b)) for b in re.split(r"</?(?:p|h1|li|div)\b[^>]*>", body)]
        assert r.text == "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)
        assert r.n_chars == len(r.text)


def test_pipeline_runs_and_only_takes_away_or_repeats(spark, folder):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = docs
    for place, (_, stage) in enumerate(pipeline.STAGES):
        before = {r.doc_id for r in now.select("doc_id").collect()}
        now = stage(spark, now, folder)
        if place < 4:
            assert now.columns == docs.columns
        assert {r.doc_id for r in now.select("doc_id").collect()} <= before
    rows = now.collect()
    assert len({(r.shard, r.slot) for r in rows}) == len(rows) > 0
