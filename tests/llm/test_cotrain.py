"""Co-training on words that only unlabelled documents have."""

import random

from almanack.llm.cotrain import scored


def test_a_rare_kind_among_many_unlabelled_documents_gets_its_label(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(12_000):
        bad = i % 4 == 0
        words = rng.choices([f"w{chr(97 + k)}" for k in range(20)], k=8)
        if bad and rng.random() < 0.8:
            words.append("buy")
        if i < 400:
            labels.append((i, 0 if bad else 1, 0))
        elif bad and i % 600 == 0:
            words.append("zzq")
        rows.append((i, " ".join(words), "spam" if bad else "fine", "en"))
    rows += [(20_000, "wa wb wc zzq", "fine", "en"), (20_001, "wa wb wc wd", "fine", "en"), (None, "wa", "fine", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = scored(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.text_score for r in got.where("doc_id IS NULL OR doc_id >= 20000").collect()}
    assert len(got) == 3 and got[20_000] < got[20_001] - 0.05, got


def test_words_take_two_bytes_and_rows_of_a_round_go_with_it(spark):
    from pathlib import Path

    from almanack.llm.cotrain import TEXT, _opened, staged_blocks
    from almanack.sources.sinks import shared_folder

    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(10**9):x}" for _ in range(1500)), "s" if i % 2 else "t", "en") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(2)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("*-*"))
    made = list(_opened(staged_blocks(docs, labels, 20).toArrow().to_batches()))
    assert scored(docs, labels, max_held=20).count() == 80
    left = set(folder.glob("*-*")) - before
    cells = sum(len(parts[TEXT][1]) for *_, parts in made)
    assert sum(len(good) for _, good, _, _ in made) == 80 and cells > 110_000
    assert sorted(p.name.split("-")[0] for p in left) == ["views", "views"]
    assert all(sum(f.stat().st_size for f in p.glob("*.parquet")) < 2.5 * cells for p in left)
