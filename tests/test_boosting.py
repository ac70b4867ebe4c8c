"""Trees for many models at once, and boosting on them, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.operators import boosted as B
from almanack.operators import manytrees as T


def data(models=3, rows=220, slots=6, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for m in range(models):
        x = rng.integers(0, 9, (rows, slots))
        y = 2.0 * (x[:, 1] > 4) + (x[:, 3] > m + 2) * (x[:, 0] > 3) + rng.normal(0, 0.3, rows)
        out += [(m, i, bytes(x[i].astype(np.uint8)), float(y[i])) for i in range(rows)]
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(data(), "model int, id long, bins binary, y double").repartition(4).cache()


def arrays(model, of=None):
    own = [r for r in of or data() if r[0] == model]
    return np.array([list(r[2]) for r in own]), np.array([r[3] for r in own]), [r[1] for r in own]


def brute_tree(x, g, w, draw, rule, model, tree, node=0, level=0):
    """Nested search over all slots and cuts: ``{node: (slot, bin, value)}``."""
    value = g.sum() / (w.sum() + rule.penalty)
    best = (1e-9, -1, -1)
    if level < rule.depth and len(g) > 1:
        for slot in draw.of(model, tree, level):
            for cut in range(T.BINS):
                left = x[:, slot] <= cut
                if left.all() or not left.any() or min(w[left].sum(), w[~left].sum()) < rule.least:
                    continue
                gain = sum(g[s].sum() ** 2 / (w[s].sum() + rule.penalty) for s in (left, ~left)) - g.sum() ** 2 / (w.sum() + rule.penalty)
                if gain > best[0] + 1e-9:
                    best = (gain, int(slot), cut)
    out = {node: (best[1], best[2], value)}
    if best[1] >= 0:
        left = x[:, best[1]] <= best[2]
        for side, child in ((left, 2 * node + 1), (~left, 2 * node + 2)):
            out |= brute_tree(x[side], g[side], w[side], draw, rule, model, tree, child, level + 1)
    return out


@pytest.mark.parametrize("in_task", [10 ** 6, 60, 0])
def test_trees_match_a_search_over_all_splits(rows, in_task):
    rule, draw = T.Rule(3, 1.0, 1.0), T.Draw(6, 0.7, 0.8, seed=3)
    found = T.grow(rows.withColumns({"g": F.col("y"), "w": F.lit(1.0)}), [220] * 3, 5, draw, rule, in_task)
    got = {}
    for model, _, node, slot, cut, value in found.rows(5):
        got.setdefault(model, {})[node] = (slot, cut, value)
    for m in range(3):
        x, y, _ = arrays(m)
        want = brute_tree(x, y, np.ones(len(y)), draw, rule, m, 5)
        assert got[m].keys() == want.keys()
        for node, (slot, cut, value) in want.items():
            assert got[m][node][:2] == (slot, cut) and np.isclose(got[m][node][2], value)


def test_draws_are_nested_shares_and_repeat():
    draw = T.Draw(70, 0.2, 0.7, seed=9)
    per_tree = {t: set() for t in range(5)}
    for t in per_tree:
        for level in range(7):
            own = draw.of(2, t, level)
            assert len(own) == 9 and (own == draw.of(2, t, level)).all()
            per_tree[t] |= set(own.tolist())
        assert len(per_tree[t]) <= 14
    assert len({frozenset(s) for s in per_tree.values()}) == 5
    some = T.Draw(70, 0.2, 0.7, seed=9, allowed=((1, 5, 9), (4,)))
    assert set(some.of(0, 1, 1).tolist()) < {1, 5, 9} and some.of(1, 3, 2).tolist() == [4]


def test_boosting_matches_a_replay(rows, monkeypatch):
    monkeypatch.setattr(B, "KEEP", 3)
    rule, draw, rate = T.Rule(2, 1.0, 1.0), T.Draw(6, 0.7, 0.8, seed=1), 0.3
    start, trees = B.boost(rows, 3, ["id"], draw, trees=8, rate=rate, share=1.0, rule=rule)
    got = {(r.model, r.id): r.prediction for r in B.boosted_values(rows, start, trees, rate).collect()}
    for m in range(3):
        x, y, ids = arrays(m)
        p = np.full(len(y), y.mean())
        for t in range(8):
            tree = brute_tree(x, y - p, np.ones(len(y)), draw, rule, m, t)
            for i in range(len(y)):
                node = 0
                while tree[node][0] >= 0:
                    node = 2 * node + 1 + (x[i, tree[node][0]] > tree[node][1])
                p[i] += rate * tree[node][2]
        assert np.allclose([got[m, i] for i in ids], p)
        assert ((y - p) ** 2).mean() < 0.5 * y.var()


def test_row_draw_is_about_its_share(rows):
    start, trees = B.boost(rows, 3, ["id"], T.Draw(6), trees=2, rate=0.3, share=0.5, rule=T.Rule(1, 1.0, 1.0))
    assert all(220 * 0.3 < w < 220 * 0.7 for t in trees for w in t.weight[:, 0])
    assert not np.allclose(trees[0].weight[:, 0], trees[1].weight[:, 0])


def replay_stumps(x, y, rounds):
    w, votes = np.ones(len(y)), []
    rule = T.Rule(1)
    for t in range(rounds):
        tree = brute_tree(x, w * y, w, T.Draw(x.shape[1]), rule, 0, t)
        leaf = np.zeros(len(y), int) if tree[0][0] < 0 else 1 + (x[:, tree[0][0]] > tree[0][1])
        said = np.array([tree[n][2] > 0.5 for n in leaf])
        error = w[said != (y > 0.5)].sum() / w.sum()
        if error < 1e-12:
            votes.append((1.0, said))
            break
        if error >= 0.5:
            break
        vote = np.log((1 - error) / error)
        votes.append((vote, said))
        w = w * np.exp(vote * (said != (y > 0.5)))
        w /= w.sum() / len(w)
    return votes


def test_stumps_match_a_replay(rows, monkeypatch):
    monkeypatch.setattr(B, "KEEP", 4)
    labelled = rows.withColumn("y", (F.col("y") > 1.3).cast("double"))
    # the last model has an unerring slot, and ends after one round
    sure = labelled.where("model = 0").withColumns({"model": F.lit(3), "bins": F.unhex(F.when(F.col("y") > 0, "020101010101").otherwise("010101010101"))})
    found = B.fit_stumps(labelled.unionByName(sure), 4, T.Draw(6), rounds=11)
    got = {(r.ensemble, r.id): r.probability for r in B.bag_votes(
        labelled.withColumn("ensemble", F.col("model")), found, [[0], [1], [2]]).collect()}
    for m in range(3):
        x, y, ids = arrays(m)
        votes = replay_stumps(x, (y > 1.3).astype(float), 11)
        assert np.allclose([v[m] for v in found.votes], [v for v, _ in votes])
        total = sum(v for v, _ in votes)
        decision = sum(v * np.where(said, 1, -1) for v, said in votes) / total
        assert np.allclose([got[m, i] for i in ids], 1 / (1 + np.exp(-decision)))
    assert [v[3] for v in found.votes] == [1.0] + [0.0] * 10


def test_bins_by_cuts(spark):
    rows = spark.createDataFrame(
        [("a", [float(i), 1.0, None]) for i in range(100)] + [("b", [1.0, float("nan"), 7.0])],
        "series string, slots array<double>",
    )
    cuts = T.bin_cuts(rows)
    got = T.with_bins(rows, cuts).collect()
    bins = sorted((r.slots[0], list(r.bins)) for r in got if r.series == "a")
    firsts = [b[0] for _, b in bins]
    assert firsts == sorted(firsts) and firsts[0] == 1 and len(set(firsts)) == T.BINS and max(firsts) == T.BINS
    assert {(b[1], b[2]) for _, b in bins} == {(1, 0)}
    assert [list(r.bins) for r in got if r.series == "b"] == [[1, 0, 1]]
    new = spark.createDataFrame([("a", [1e9, 0.0, 3.0]), ("c", [1.0, 1.0, 1.0])], rows.schema)
    assert sorted(list(r.bins) for r in T.with_bins(new, cuts).collect()) == [[1, 1, 1], [32, 1, 1]]
