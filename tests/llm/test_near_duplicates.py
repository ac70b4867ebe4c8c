"""BagMinHash, cross-polytope hashing, components: against brute force."""

import random
from collections import Counter

import numpy as np

from almanack.llm.bag_minhash import band_keys, classes, keep_one, overlap, shingles, signatures
from almanack.llm.components import _star, components
from almanack.llm.hadamard import hadamard, linked
from almanack.llm.textbytes import SOLID, U, chunks, mixed, words


def bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(docs, similarity=0.8):
    ids = [i for i, _ in docs]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = {i: bag(t) for i, t in docs}
    for a in ids:
        for b in ids:
            if a < b:
                x, y = bags[a], bags[b]
                common = sum((x & y).values())
                union = sum((x | y).values())
                if (union and common >= similarity * union) or (not union):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def variants(seed, n=24):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    docs = []
    for i in range(n):
        base = rng.choices(vocabulary, k=rng.choice([3, 30, 120, 400]))
        docs.append(list(base))
        for _ in range(rng.choice([0, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy + (["tail"] * 40 if rng.random() < 0.2 else []))
    docs += [["same"] * 900, ["same"] * 1000, ["same"] * 1300, [], []]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def test_classes_match_brute_force(spark):
    docs = variants(1)
    frame = spark.createDataFrame([*docs, (900, None)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in classes(frame).collect()}
    want = brute_classes([*docs, (900, None)])
    assert got == want


def test_signatures_estimate_weighted_similarity():
    a = np.repeat(np.arange(300), 4)
    b = np.concatenate((np.repeat(np.arange(300), 3), np.arange(300, 400)))
    keys = mixed(np.concatenate((a, b)).astype(U))
    s = signatures(keys, np.array([0, len(a), len(a) + len(b)]), 4000)
    common, union = 900, 1200 + 1000 - 900
    assert abs((s[0] == s[1]).mean() - common / union) < 0.03
    assert band_keys(s, 800).shape == (2, 800)


def test_a_large_weight_costs_few_points():
    key = mixed(np.zeros(200_000, U))
    a, b = (signatures(key[:n], np.array([0, n]), 160) for n in (200_000, 190_000))
    assert 0.85 < (a == b).mean() <= 1


def test_overlap_counts_repeats():
    assert overlap(np.array([1, 1, 2, 5]), np.array([1, 1, 1, 5, 7])) == 3


def test_short_rows_are_one_shingle():
    h = np.arange(1, 8, dtype=U)
    s, at = shingles(h, np.array([0, 0, 1, 7]))
    assert at.tolist() == [0, 0, 1, 3] and len(s) == 3


def test_words_of_bytes_match_plain_python():
    import pyarrow as pa

    texts = ["Ä b\tC", "", None, " x", "y", "a" * 5000 + " z", "b\n\n b"]
    got = []
    for _, _, x, at in chunks(pa.array(texts), 16):
        h, of = words(x, at, SOLID)
        got += [h[a:b].tolist() for a, b in zip(of[:-1], of[1:])]
    low = [[w for w in (t or "").replace("C", "c").split()] for t in texts]
    assert [len(g) for g in got] == [len(w) for w in low]
    seen = {}
    for g, w in zip(got, low):
        for k, v in zip(w, g):
            assert seen.setdefault(k, v) == v
    assert len(set(seen.values())) == len(seen)


def test_keep_one_keeps_columns_and_idless_rows(spark):
    docs = spark.createDataFrame(
        [(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z"), (3, None, "q"), (3, None, "q")],
        "doc_id long, text string, component string",
    )
    got = keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component) for r in got.collect()) == [(0, "z"), (1, "y"), (3, "q")]
    assert keep_one(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(30)] + [(500, 499), (499, 498), (7, 7)]
    got = components(spark.createDataFrame(path + star, "a long, b long")).collect()
    label = {r.node: r.component for r in got}
    assert len(got) == len(label)
    assert all(label[i] == 0 for i in range(41)) and all(label[200 + i] == 100 for i in range(30))
    assert label[500] == label[498] == 498


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose((hadamard(x) ** 2).sum(1), (x**2).sum(1)) and np.allclose(hadamard(hadamard(x)), x)


def test_links_match_brute_force_with_odd_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 24))
    rows = [v for b in base for v in [b, *(b + 0.3 * rng.normal(size=(6, 24)))]]
    rows += [rows[0], rows[0], [0.0] * 24, None, [], [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1e200] * 24, [1e-200] * 24]
    rows += [list(range(1, 6)), list(range(1, 6)), [-0.0, 1.0], [0.0, 1.0]]
    rows = [None if v is None else [float(x) for x in v] for v in rows] + [[1.0, None] + [1.0] * 22]
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in linked(frame, block=4).collect()}
    unit = {}
    for i, v in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    links = {i: {j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9} for i in unit}
    found = sum(n for n, _ in got.values())
    assert len(got) == len(rows)
    assert found >= 0.99 * sum(map(len, links.values()))
    assert all(got[i][0] <= len(links.get(i, ())) for i in got)
    assert all(got[i] == (0, i) for i in range(len(rows)) if i not in unit)
    tail = len(rows) - 1
    assert got[tail - 1] == (1, tail - 2) and got[tail - 3] == (1, tail - 4)


def test_a_round_of_components_reads_its_links_once_a_use(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(900, 960)] + [(rng.randrange(500, 800), rng.randrange(500, 800)) for _ in range(150)]
    frame = spark.createDataFrame(links, "a long, b long")
    plan = _star(_star(frame, small=False), small=True)._jdf.queryExecution().optimizedPlan()
    # two steps, each with a minimum and a join; with the plan of the first step held six times it was 24
    assert plan.collectLeaves().size() == 4
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = [tuple(r) for r in components(frame).collect()]
    assert sorted(got) == sorted((i, find(i)) for i in root)
