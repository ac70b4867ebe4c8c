"""Shards of rows with repeated and missing ids."""

from almanack.llm.shard import ranked, shuffled


def test_buckets_keep_their_size_with_repeated_and_null_ids(spark):
    from pyspark.sql import functions as F

    rows = [(None if i % 2 else 7, f"t{i}") for i in range(200)] + [(None, "same")] * 9000 + [(1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = ranked(docs).where("text = 'same'").agg(F.count("*"), F.countDistinct("_rank"), F.min("_rank"), F.max("_rank")).head()
    assert tuple(ranks) == (9000, 9000, 0, 8999)
    one, again = (shuffled(d, bucket_bytes=4096).orderBy("shard", "slot").collect() for d in (docs, docs.repartition(5)))
    assert one == again and sorted(r.text for r in one) == sorted(t for _, t in rows)
    places = [k for k, r in enumerate(one) if r.doc_id == 7]
    assert max(places) - min(places) > len(rows) // 2
    assert len({r.shard for r in one if r.doc_id == 7}) > 8
