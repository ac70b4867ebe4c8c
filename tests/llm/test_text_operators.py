"""Decontamination, mixing, lines, pages, WARC, scores: small cases and brute force."""

import hashlib
import json
import math
import re

import numpy as np

from almanack.llm import ctw, warc
from almanack.llm.decontaminate import clean, digest, find_occurrences
from almanack.llm.html_extract import common_lines, extract, lines_of, main_text
from almanack.llm.line_dedup import dedup_lines
from almanack.llm.mix import mix, mixed_sizes, targets
from almanack.llm.shard import shuffled


def split(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, items, width=10):
    out = {}
    for i, t in docs:
        w, hit, names = split(t), set(), set()
        for name, it in items:
            own = split(it) if name is not None else []
            n = min(width, len(own))
            for a in range(len(own) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == own[a : a + n]:
                        hit.update(range(b, b + n))
                        names.add(str(name))
        out[i] = (len(w), len(hit), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
    return out


def test_occurrences_match_brute_force(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    items = [(10, item), (9, "Short one"), (2, item + " thirteen"), (3, None), (None, "lost"), (4, ""), (9, "again é")]
    docs = [
        (0, "x " + item.upper() + ", y"), (1, "short-ONE"), (2, None), (3, ""), (4, "again É again é"), (5, (item + " ") * 3),
        (6, "two three four five six seven eight nine ten eleven"), (7, "lost two one"), (8, "one " * 30), (9, "short"),
        (10, "one short one"), (11, "filler " * 5000 + item),
    ]
    d = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, hit_items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute_hits(docs, items)
    for block_words in (10**6, 12):
        rows = digest(find_occurrences(d, b, block_words=block_words)).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.items_sha256) for r in rows} == want
    kept = clean(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i in want if not want[i][1]}
    assert clean(d, b.limit(0)).count() == len(docs) and find_occurrences(d.limit(0), b).count() == 0


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100), (None, 40)], "source string, source_size long")
    got = {r.source: r.target for r in targets(sizes).collect()}
    assert got["b"] == 30 and got["c"] == 300 and math.isclose(sum(got.values()), 1150)
    assert math.isclose(got["a"], got[None]) or got[None] == 120


def test_mix_repeats_rows_and_is_stable(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    taken = {r.doc_id: r for r in mixed_sizes(docs).collect()}
    counts = {r.doc_id: r["count"] for r in mix(docs.repartition(5)).groupBy("doc_id").count().collect()}
    assert counts == {i: r.taken // r["size"] for i, r in taken.items() if r.taken}
    by = {}
    for r in taken.values():
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        got = sum(r.taken for r in rows)
        assert abs(got - rows[0].target) <= max(r["size"] for r in rows) / 2 + 1
        assert all(r.taken <= 3 * r["size"] for r in rows)


def test_mix_of_odd_rows(spark):
    rows = [(1, "a", "w w"), (1, "a", "w w"), (2, None, None), (3, None, "x"), (None, "b", "y y y"), (4, "a", "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, source string, text string, size int")
    assert mixed_sizes(docs).count() == 6
    out = mix(docs)
    assert out.columns == docs.columns and out.where("text IS NULL OR text = ''").count() == 0
    assert mixed_sizes(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (None, None, 6), (2, "", 7)], "doc_id long, text string, shard int")
    rows = shuffled(docs, shards=3).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4
    assert shuffled(docs.limit(0)).count() == 0


def brute_lines(docs):
    """The rule read literally: a line goes when an earlier one is equal or within a word."""

    def near(a, b):
        if len(a) < 5 or len(b) < 5:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) < len(b):
            a, b = b, a
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    seen, out = [], {}
    for i, t in sorted(docs):
        kept = []
        for line in t.split("\n"):
            w = line.split()
            if w and any(w == s or near(w, s) for s in seen):
                seen.append(w)
                continue
            seen.append(w)
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


def test_lines_match_brute_force(spark):
    import random

    rng = random.Random(5)
    pool = [" ".join(rng.choices("a b c d e f".split(), k=rng.choice([1, 4, 5, 6, 7, 12]))) for _ in range(40)]
    docs = [(i, "\n".join(rng.choice(pool) + rng.choice(["", "", " x", "  "]) for _ in range(8)) + "\n\n") for i in range(30)]
    frame = spark.createDataFrame([*docs, (99, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(frame).collect()}
    assert got.pop(99) is None
    assert got == brute_lines(docs)


def test_lines_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "k k", 1), (1, "k  k\nm", 2), (2, "", 3), (2, "m", 4)], "doc_id long, text string, n_near int")
    rows = {(r.doc_id, r.text) for r in dedup_lines(docs).collect()}
    assert rows == {(None, "k k"), (1, "m"), (2, ""), (2, "")}
    assert dedup_lines(docs.limit(0)).count() == 0


def test_common_lines_are_a_longest_common_subsequence():
    assert common_lines([1, 2, 3, 4, 2], [2, 4, 9, 2]) == {1, 3, 4}
    assert common_lines([], [1]) == set() and common_lines([1], []) == set()


def test_pages_without_markup_lose_what_the_nearest_page_shares(spark):
    page = "<html><head><title>T</title></head><body><p>Shop Home</p><p>{}</p><p>{}</p><p>All rights</p></body></html>"
    rows = [
        (1, "http://h.org/a/1", page.format("First &amp; own", "More\n own  text")),
        (2, "http://h.org/a/2", page.format("Second text", "is here &#233;")),
        (3, "http://h.org/b/1", "<div>lone</div>"),
        (4, None, None), (5, "odd", "x<br>y"), (6, "http://q.org/", "<p>a</p>"), (7, "http://q.org/", "<p>a</p>"),
    ]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")).collect()}
    assert got == {1: "First & own\nMore own text", 2: "Second text\nis here é", 3: "lone", 4: "", 5: "x y", 6: "a", 7: "a"}


def test_common_prefixes_of_paths(spark):
    from os.path import commonprefix

    from pyspark.sql import functions as F

    from almanack.llm.html_extract import _prefix

    long = "/x" * 20_000
    pairs = [("", ""), ("", "/a"), ("/a", "/a"), ("/a", "/ab"), ("/ab", "/ac"), ("a", "b"), ("/ä\U0001f600x", "/ä\U0001f600y"), (long + "a", long + "b")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", _prefix(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in rows] == [len(commonprefix([a, b])) for a, b in pairs]


def test_markup_decides_where_it_speaks():
    page = (
        "<body><header>Top</header><div class='cookie-notice'>ok?</div><main><h1>T</h1><p>a <b>b</b><p>c<script>x<p></script>"
        "<aside>side</aside><form>f</form><ul><li>one<li>two</ul><div class='comments'><p>nice</p></div></main><footer>f</footer>"
    )
    assert main_text(page, None) == "T\na b\nc\none\ntwo"
    named = "<div class='has-sidebar'><div class='sidebar-content'>side</div><div class='entry-content'>a<div class='ad'>b</div></div><p>c</p></div>"
    assert main_text(named, None) == "a"
    assert main_text("<p>x</p><div id='comments'>y</div><section class='comment-list'>z</section>", None) == "x"
    assert main_text(None, None) == "" and lines_of("<!-- a <p>b</p> -->") == []
    assert main_text("<p>1 < 2 &lt;b&gt;</p><!-- open", None) == "1 < 2 <b>"


def test_warc_round_trip_and_links(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T é</title><a href='/x'>go</a>"), (2, None, None)], "page_id long, url string, html string")
    responses = warc.responses_of(pages, keep=["page_id"])
    rows = warc.derivatives(responses, keep=["page_id"]).collect()
    own = {r.page_id: r.headers for r in responses.collect()}
    assert len(rows) == 4
    for r in rows:
        h = r.headers
        assert h["WARC-Refers-To"] == own[r.page_id]["WARC-Record-ID"]
        assert h["WARC-Source-Payload-Digest"] == own[r.page_id]["WARC-Payload-Digest"]
        assert h["WARC-Block-Digest"] == warc.digest(r.content.encode()) and int(h["Content-Length"]) == len(r.content.encode())
        assert any(o.headers["WARC-Record-ID"] == h["WARC-Concurrent-To"] and o.page_id == r.page_id for o in rows)
    meta = json.loads(next(r.content for r in rows if r.page_id == 1 and r.headers["WARC-Type"] == "metadata"))
    assert meta["links"] == ["/x"] and meta["title"] == "T é" and meta["http"]["Content-Type"].startswith("text/html")
    assert meta["source"] == own[1]
    made = warc.derivatives(responses)
    warc.write_records(made, str(tmp_path / "w"))
    back = warc.read_records(spark, str(tmp_path / "w")).collect()
    assert all(r.complete for r in back)
    key = lambda h, b: (sorted(h.items()), b)
    assert sorted(key(r.headers, bytes(r.block).decode()) for r in back) == sorted(key(r.headers, r.content) for r in made.collect())
    raw = warc.responses_of(pages.where("page_id = 1"))
    warc.write_records(raw, str(tmp_path / "r"), block="block")
    assert [(r.headers, bytes(r.block)) for r in warc.read_records(spark, str(tmp_path / "r")).collect()] == [(r.headers, bytes(r.block)) for r in raw.collect()]


def test_weights_are_those_of_context_tree_weighting():
    """One decision, contexts 0 and 1: the recursion by hand."""
    a, b = np.array([3.0, 4.0]), np.array([1.0, 2.0])
    kt = lambda x, y: math.exp(float(ctw.log_kt(np.array([x]), np.array([y]))[0]))
    assert math.isclose(kt(1.0, 1.0), 1 / 8) and math.isclose(kt(0.0, 2.0), 3 / 8) and math.isclose(kt(0.0, 0.0), 1)
    root = (np.array([1], np.uint64), np.array([7.0]), np.array([5.0]))
    kids = (np.array([(65 << 8) | 1, (66 << 8) | 1], np.uint64), a, b)
    model = ctw.weigh([root, kids])
    whole, split = 0.5 * kt(7.0, 5.0), 0.5 * kt(3.0, 1.0) * kt(4.0, 2.0) * kt(0.0, 2.0)
    beta = whole / (whole + split)
    mine = beta * 5.5 / 13 + (1 - beta) * 1.5 / 5
    assert math.isclose(model[1][1][0], mine, rel_tol=1e-5)
    assert math.isclose(model[0][1][0], beta * 5.5 / 13 + (1 - beta) * 2.5 / 3, rel_tol=1e-5)


def test_byte_probabilities_sum_to_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text").limit(50)
    counts = docs.mapInArrow(ctw._count, "kind int, key long, n long").groupBy("kind", "key").sum("n").toDF("kind", "key", "n")
    model = ctw.learn(counts, counts.where("kind = 1").agg({"n": "sum"}).head()[0], least=1e-4)
    for context in (b"\n\n\n\n\n", b" the ", b"zzzzz", bytes([200, 10, 3, 0, 255])):
        keys = (int.from_bytes(context, "big") << 8) + np.arange(256, dtype=np.uint64)
        assert math.isclose((10.0 ** ctw.log_probabilities(model, keys)).sum(), 1, rel_tol=1e-4)


def test_scores_match_plain_counting(spark, folder):
    import zlib
    from collections import Counter

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(120)
    extra = spark.createDataFrame([(9001, None), (9002, " \t"), (9003, "Zq zQ zq")], "doc_id long, text string")
    rows = docs.union(extra).collect()
    got = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows, docs.schema)).collect()}
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    count = Counter(w for r in rows if not held[r.doc_id] for w in [*low(r.text), None])
    n, v = sum(count.values()), len(count)
    for r in rows:
        tokens = [*low(r.text), None]
        g = got[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[r.doc_id], len(tokens), sum(w in count for w in tokens), n)
        assert math.isclose(g.base_score, base, rel_tol=1e-9) and g.score < 0
    assert ctw.score(docs.limit(0)).count() == 0


def test_context_trees_beat_single_words_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    row = ctw.score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").head()
    assert row.s > row.b


def brute_tree(training, depth):
    """log10 of the probability of a byte after its context, as ratios of weighted block
    probabilities, by plain recursion over the trees."""
    counts, kids = {}, {}

    def steps(context, byte):
        for k in range(8):
            yield (byte >> (8 - k)) | (1 << k), context, (byte >> (7 - k)) & 1

    for seq in training:
        for i, byte in enumerate(seq):
            for prefix, context, bit in steps((b"\n" * depth + seq)[i : i + depth], byte):
                for d in range(depth + 1):
                    node = (prefix, context[depth - d :])
                    counts.setdefault(node, [0, 0])[bit] += 1
                    if d:
                        kids.setdefault((prefix, context[depth - d + 1 :]), set()).add(node)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    known = {}

    def weighted(node, more=None):
        """Log weighted probability; with ``more`` (context, bit) one more bit is seen."""
        if more is None and node in known:
            return known[node]
        a, b = counts.get(node, (0, 0))
        if more:
            a, b = (a + 1, b) if more[1] == 0 else (a, b + 1)
        out, d = kt(a, b), len(node[1])
        if d < depth:
            path = (node[0], more[0][depth - d - 1 :]) if more else None
            split = sum(weighted(k) for k in kids.get(node, ()) if k != path) + (weighted(path, more) if more else 0)
            out = math.log(0.5) + float(np.logaddexp(out, split))
        if more is None:
            known[node] = out
        return out

    def chance(context, byte):
        return sum(
            weighted((prefix, b""), (context, bit)) - weighted((prefix, b"")) for prefix, context, bit in steps(context, byte)
        ) / math.log(10)

    return chance


def test_scores_match_brute_force_trees(spark):
    import zlib

    texts = [f"{a} {b} {a}{b}" for a in ("the cat", "a dog", "une é", "zz", "") for b in ("sat", "sat on", "x", "the")]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None)]
    low = lambda t: (" ".join((t or "").split()) + "\n").encode()
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    assert 0 < len(held) < len(rows)
    for depth in (2, 4):
        chance = brute_tree([low(t) for i, t in rows if i not in held], depth)
        got = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=depth, visits=1).collect()}
        for i, t in rows:
            seq = low(t)
            want = sum(chance((b"\n" * depth + seq)[k : k + depth], byte) for k, byte in enumerate(seq))
            assert math.isclose(got[i].score, want, rel_tol=1e-6), (depth, t)
            assert got[i].n_bytes == len(seq) and math.isclose(got[i].bits_per_byte, -want / math.log10(2) / len(seq), rel_tol=1e-6)


def test_scores_of_strings_that_training_never_saw(spark):
    import zlib

    ids = {held: [i for i in range(200) if (zlib.crc32(str(i).encode()) % 7 == 2) == held] for held in (False, True)}
    low = lambda t: (" ".join(t.split()) + "\n").encode()
    texts = [(False, "aa ab"), (True, "xyz zyx"), (False, "ab aa b"), (True, "q\u00e9 7"), (True, "aa xyz")]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        # so many partitions that some hold strings of held-out rows alone
        for k, v in zip(old, ("64", "false")):
            spark.conf.set(k, v)
        for some in (texts, [t for t in texts if t[0]]):
            rows = [(ids[held][k], t) for k, (held, t) in enumerate(some)]
            chance = brute_tree([low(t) for held, t in some if not held], 3)
            got = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=3, visits=1).collect()}
            for i, t in rows:
                seq = low(t)
                want = sum(chance((b"\n" * 3 + seq)[k : k + 3], byte) for k, byte in enumerate(seq))
                assert math.isclose(got[i].score, want, rel_tol=1e-6), t
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_subtrees_by_group_give_the_whole_model(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text").limit(50)
    counts = docs.mapInArrow(ctw._count, "kind int, key long, n long").groupBy("kind", "key").sum("n").toDF("kind", "key", "n").cache()
    model = ctw.learn(counts, 0)
    got = ctw.string_values(counts).toArrow()
    keys = got.column("key").to_numpy().view(np.uint64)
    assert len(keys) == counts.where("kind = 1").count()
    assert np.allclose(got.column("value").to_numpy(), ctw.log_probabilities(model, keys), rtol=1e-9, atol=1e-9)


def test_scores_do_not_depend_on_the_blocks(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(40)
    docs = docs.union(docs.limit(3)).cache()
    one = sorted(ctw.score(docs).collect())
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 5_000)
    many = sorted(ctw.score(docs).collect())
    assert len(one) == len(many) == docs.count()
    for a, b in zip(one, many):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)


def test_context_trees_beat_single_words_on_held_out_text_of_a_smaller_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = ctw.score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").head()
    assert row.s > row.b


def test_classifier_on_held_out_labels(spark):
    from pyspark.sql import functions as F

    from almanack.llm.cotrain import scored as classify

    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = F.pmod(F.xxhash64(F.lit(77), "doc_id"), F.lit(5)) == 0
    scored = classify(docs, labels.where(~held)).join(labels.where(held), "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    right = scored.groupBy(good.alias("good")).agg(F.avg((F.col("keep") == good).cast("double")).alias("share"))
    shares = {r.good: r.share for r in right.collect()}
    # a fifth of the toxic labels, and so some of the bad ones, have nothing in the text to show for it
    assert shares[True] > 0.98 and shares[False] > 0.85, shares


def test_classifier_without_labels_keeps_all(spark):
    from almanack.llm.cotrain import good_only, scored as classify

    docs = spark.createDataFrame([(1, "a", None, None, 0.5), (None, None, "s", "en", 1.0)], "doc_id long, text string, source string, lang string, score double")
    labels = spark.createDataFrame([(1, None, 1)], "doc_id long, quality int, toxic int")
    assert classify(docs, labels).where("keep AND score = 1").count() == 2
    assert good_only(docs, labels).columns == docs.columns and good_only(docs.limit(0), labels).count() == 0


def test_strings_of_a_block_travel_packed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "false", "text").coalesce(1)
    blocks = docs.mapInArrow(ctw._make_blocks(1 << 30), "block long, docs binary").cache()
    rows = blocks.mapInArrow(ctw._count_blocks(ctw.DEPTH), "pair int, block long, size long, keys binary, counts binary").where("pair < 65536")
    assert blocks.count() == 1
    row = rows.selectExpr("sum(size) keys", "sum(octet_length(keys) + octet_length(counts)) bytes").head()
    counts = docs.select("text").mapInArrow(ctw._count, "kind int, key long, n long").where("kind = 1")
    assert row.keys == counts.select("key").distinct().count() and row.bytes < 6 * row.keys
    got = rows.toArrow().to_pylist()
    keys = [ctw._sorted_keys(r["keys"], r["size"]) for r in got]
    assert all((k[1:] > k[:-1]).all() and ((k >> np.uint64(8)) & np.uint64(65535) == r["pair"]).all() for k, r in zip(keys, got))
    n = sum(int(ctw._unplanes(r["counts"], r["size"]).sum()) for r in got)
    assert n == counts.agg({"n": "sum"}).head()[0]


def test_memory_of_a_block_does_not_follow_its_strings(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "false", "text").coalesce(1)
    blocks = docs.mapInArrow(ctw._make_blocks(1 << 30), "block long, docs binary").toArrow().combine_chunks()
    for name, value in {"HOLD": 1 << 16, "BLOCK_CHUNK": 1 << 16, "SHARE_KEYS": 1 << 16, "SHARE_PLACES": 1 << 18}.items():
        monkeypatch.setattr(ctw, name, value, raising=False)
    tracemalloc.start()
    try:
        rows = pa.Table.from_batches(list(ctw._count_blocks(ctw.DEPTH)(blocks.to_batches()))).to_pylist()
        counted = tracemalloc.get_traced_memory()[1]
        hashed = lambda k: (k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(30)
        for r in rows:
            keys = ctw._sorted_keys(r["keys"], r["size"])
            r["values"] = ctw._planes(hashed(keys)) if r["pair"] < 1 << 16 else r["counts"]
        strings = sum(r["size"] for r in rows if r["pair"] < 1 << 16)
        values = pa.table({c: pa.array([r[c] for r in rows], kind) for c, kind in {"pair": pa.int32(), "size": pa.int64(), "keys": pa.binary(), "values": pa.binary()}.items()})
        del rows
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        got = ctw._score_block(blocks, values, ctw.DEPTH)
        scored = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    text = sum(got["bytes"].to_pylist())
    assert strings > 500_000
    for r, score in zip(docs.limit(20).collect(), got["score"].to_pylist()):
        seq, at = ctw.sequences(np.frombuffer(re.sub("[A-Z]", lambda m: m[0].lower(), r.text).encode(), np.uint8), np.array([0, len(r.text.encode())]))
        past = b"\n" * ctw.DEPTH + seq.tobytes()
        keys = [int.from_bytes(past[i : i + ctw.DEPTH + 1], "big") for i in range(len(seq))]
        assert score == -int(hashed(np.array(keys, np.uint64)).sum()) / ctw.STEP
    # counting once took 35.6 MB
    assert counted < 2 * text + (6 << 20) and scored < 2 * text + (6 << 20)
