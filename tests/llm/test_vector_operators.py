"""Vantage-point trees, slot negatives and contour whitening: against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.llm import hard_negatives as H
from almanack.llm import vp_trees as T
from almanack.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int"
ODD = [
    (1001, None, 1), (1002, [], 1), (1003, [0.0] * 4, 1), (1004, [1.0, None, 0.0, 0.0], 1),
    (1005, [1.0, float("nan"), 0.0, 0.0], 1), (1006, [1.0, float("inf"), 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0, 0.0], 1),
    (1007, [1.0, 2.0], 1), (1100, [1.0, 3.0], 1), (1008, [0.5, 0.25, 0.0, -0.0], None),
]


def rows_of(seed, n=400, size=4, grid=None):
    """Vectors with ties (values on a grid), copies and repeated rows."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, size))
    x = np.round(x * grid) / grid if grid else x
    x[5::7] = x[5]  # a group of copies
    rows = [(i, x[i].tolist(), int(rng.integers(0, 3))) for i in range(n)]
    return [*rows, *rows[:30], *ODD]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if not extra:
        return df
    names = ("id", "v", "size", "shard", "asks", "rank", "score", "x", "n")
    return df.withColumns({c: F.lit("other") for c in names}).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))


def usable(rows, zero):
    out = {}
    for i, v, label in rows:
        if i is None or v is None or any(c is None or not math.isfinite(c) for c in v) or (not zero and not any(v)):
            continue
        out[i] = min(out[i], (v, label)) if i in out else (v, label)
    return out


def brute_nearest(rows, k, every):
    points = {i: v for i, (v, _) in usable([(i, v, 0) for i, v, _ in rows], zero=False).items()}
    out = []
    for q, a in points.items():
        if q % every:
            continue
        found = []
        for i, b in points.items():
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += (x - y) * (x - y)
                found.append((math.sqrt(total), i))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("grid", [None, 2])
def test_factor_one_is_exact(spark, grid, monkeypatch):
    monkeypatch.setattr(T.V, "LEAST_SHARDS", 3)
    rows = rows_of(3, grid=grid)
    got = T.nearest(frame(spark, rows), F.col("id") % 20 == 0, k=6)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, 6, 20)


def test_all_candidates_if_fewer_than_k(spark):
    rows = [(100, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)]
    got = T.nearest(frame(spark, rows, False), F.col("id") % 100 == 0)
    assert [tuple(r)[1:3] for r in got.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_huge_and_tiny_components(spark):
    rows = [(i, [s * 1.0, -s * i], 0) for i, s in enumerate([1e300, 1e300, 1e200, 1e-200, 1e-300, 1.0, 2.0])]
    got = T.nearest(frame(spark, rows, False), F.col("id") % 2 == 0, k=9)
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, 9, 2)


def test_larger_factors_visit_fewer_leaves_and_miss_little():
    rng = np.random.default_rng(1)
    middles = rng.standard_normal((40, 8)) * 6
    x = middles[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 8)) * 0.4
    ids = np.arange(6000)
    rows = list(T.build(ids, x, 0))
    tree = object.__new__(T.Tree)
    entries = [(n, b, ids[own], x[own]) for n, b, own in rows]
    tree.inner = sorted((e for e in entries if e[1]), key=lambda e: e[0])
    tree.leaves = sorted((e for e in entries if not e[1]), key=lambda e: e[0])
    tree.squares = [(v * v).sum(axis=1) for *_, v in tree.leaves]
    q = ids[::60]
    found = {f: tree.search(q, x[q], 10, f) for f in (1.0, 1.5, 3.0)}
    pairs = {f: set(zip(r.tolist(), i.tolist())) for f, (r, i, _, _) in found.items()}
    d = np.sqrt(((x[q][:, None] - x[None]) ** 2).sum(-1))
    d[np.arange(len(q)), q] = np.inf
    assert pairs[1.0] == {(r, i) for r in range(len(q)) for i in np.argsort(d[r], kind="stable")[:10].tolist()}
    visits = [found[f][3] for f in (1.0, 1.5, 3.0)]
    assert len(q) * len(tree.leaves) / 2 > visits[0] > visits[1] > visits[2]
    assert len(pairs[1.5] & pairs[1.0]) >= 0.9 * len(pairs[1.0])


def brute_negatives(rows, every, positives=5, negatives=5):
    points = {i: ([math.floor(256 * c) for c in v], label) for i, (v, label) in usable([r for r in rows if r[2] is not None], zero=True).items()}
    # the row of a repeated id is the first by label and whole numbers
    out = []
    for a, (av, al) in points.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, label) for i, (v, label) in points.items() if i != a and len(v) == len(av))
        best = [(-s, i) for s, i, label in scored if label == al][:positives]
        for p, pid in best:
            window = [(-s, i) for s, i, label in scored if label != al and 80 * p <= -100 * s <= 100 * p][:negatives]
            out += [(a, pid, r + 1, i, p, s) for r, (s, i) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("grid", [None, 2])
def test_slots_answer_every_window(spark, grid, monkeypatch):
    monkeypatch.setattr(H.V, "LEAST_SHARDS", 3)
    rows = rows_of(8, grid=grid)
    points = H.whole_numbers(frame(spark, rows), F.col("label"))
    got = H.mined(points, points.where(F.col("id") % 10 == 0))
    want = brute_negatives(rows, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_other_counts_of_positives_and_negatives(spark):
    rows = rows_of(9, n=200)
    points = H.whole_numbers(frame(spark, rows, False), F.col("label"))
    got = H.mined(points, points.where(F.col("id") % 10 == 0), positives=3, negatives=2)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10, 3, 2)


def test_scores_beyond_two_to_the_53_are_exact():
    a = np.array([[2 ** 31 + 1, 3]])
    x = np.array([[2 ** 31 - 1, 1], [2 ** 62, 2 ** 62]])
    assert H.scores(a, x).tolist() == [[(2 ** 31 + 1) * (2 ** 31 - 1) + 3, 2 ** 63 - 1]]


def test_least_score_rounds_up(spark):
    values = [0, 1, 4, 5, 99, 101, 2 ** 62]
    got = spark.createDataFrame([(v,) for v in values], "p long").select("p", H.least_score(F.col("p")).alias("s")).collect()
    assert {r.p: r.s for r in got} == {v: -(-80 * v // 100) for v in values}


def brute_whitened(rows, count=4):
    """Per length: rows' ids, whitened values up to sign, and the rest of the columns."""
    out = {}
    for i, v, _ in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            out.setdefault(len(v), []).append((i, [math.floor(256 * c) for c in v]))
    for size, own in out.items():
        fit = np.unique(np.array([x for _, x in own]), axis=0)
        n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
        centred = fit - np.array(sums) / n
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        m = min(count, int((values > 1e-9 * values.sum()).sum()))
        yield size, own, n, sums, values[:m], vectors[:, :m], values.sum()


def test_whitening_matches_a_full_decomposition(spark):
    rows = rows_of(4, size=12) + [(5000, [0.1 * k for k in range(12)], 1)] * 3
    df = W.whitened(frame(spark, rows))
    assert df.dtypes[:3] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint")]
    got = {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.deviation), []).append(r)
    seen, signs = 0, {}
    for size, own, n, sums, values, vectors, trace in brute_whitened(rows):
        for i, x in own:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            if not len(values):
                continue
            found = sorted(got[i, deviation], key=lambda r: r.component)[:: sum(1 for j, y in own if (j, y) == (i, x))]
            want = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
            assert [r.component for r in found] == list(range(1, len(values) + 1))
            assert np.allclose(np.abs([r.whitened for r in found]), np.abs(want), rtol=0, atol=1e-8)
            assert np.allclose([r.explained for r in found], values / trace, rtol=1e-9)
            assert all(r.n == n and r.identity_error < 1e-8 for r in found)
            for r, w in zip(found, want):
                if abs(w) > 1e-6:
                    signs.setdefault((size, r.component), set()).add(r.whitened * w > 0)
            seen += len(found)
    assert seen == df.count()
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 2, 1, 0.5], [5, 5, 5, 5, 5, 5], [4, 4, 3, 3, 3, 3, 1], [1, 1e-3, 1e-6, 1e-9, 1e-12], [2, 1], [7],
    [1.001, 1.0009, 1.0008, 1.0007, 1.0006, 1.0005] + [1.0] * 40,
])
def test_feast_finds_the_largest(spark, values):
    size = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((size, size)))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    got, vectors = W.components(spark, v)
    want = np.sort(values)[::-1][: len(got)]
    assert len(got) == min(4, size) and np.allclose(got, want, rtol=0, atol=1e-12 * sum(values))
    assert np.abs(v @ vectors - vectors * got).max() < 1e-12 * sum(values)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)


def test_inertia_counts():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a @ a.T
    diagonal, off = W.tridiagonal(a)
    exact = np.linalg.eigvalsh(a)
    for shift in [*((exact[1:] + exact[:-1]) / 2), exact[0] - 1, exact[-1] + 1]:
        assert W.count_above(diagonal, off, shift) == (exact > shift).sum()


def test_deviation_beyond_a_long_is_null():
    f = object.__new__(W.Fit)
    f.n, f.size, f.sums = 10 ** 9, 2, [0, 0]
    assert f.deviation(np.array([[1, 2], [4, 1]])) == [5 * 10 ** 18, None]


def test_one_vector_has_no_component(spark):
    assert W.whitened(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], False)).count() == 0


@pytest.mark.parametrize("rows", [[], ODD[:1], [(None, None, None)]])
def test_empty_tables(spark, rows):
    df = frame(spark, rows, False)
    assert T.nearest(df, F.col("id") % 100 == 0).count() == 0
    points = H.whole_numbers(df, F.col("label"))
    assert H.mined(points, points.where(F.col("id") % 100 == 0)).count() == 0
    assert W.whitened(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whitened(df).count() == 0
