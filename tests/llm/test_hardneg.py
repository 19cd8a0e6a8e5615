"""Hard negatives and cover trees against comparing all rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from payfeed.llm import hardneg
from payfeed.llm.hardneg import CoverTree


def clustered(rng, n, dim, spread=6):
    centres = rng.integers(-120, 120, (12, dim))
    return centres[rng.integers(0, 12, n)] + rng.integers(-spread, spread + 1, (n, dim))


def plain(ids, labels, v, query, vec_id, label, same, low, high, k):
    scores = v.astype(np.int64) @ query.astype(np.int64)
    ok = ((labels == label) == same) & (ids != vec_id) & (scores >= low) & (scores <= high)
    return sorted(zip(scores[ok].tolist(), ids[ok].tolist()), key=lambda x: (-x[0], x[1]))[:k]


@pytest.mark.parametrize("kind", ["clusters", "random", "copies", "zero", "one", "scales"])
def test_search_equals_all_rows(monkeypatch, kind):
    monkeypatch.setattr(hardneg, "LEAF", 8)
    monkeypatch.setattr(hardneg, "FAN", 5)
    rng = np.random.default_rng(4)
    n = 1 if kind == "one" else 700
    v = {"random": rng.integers(-200, 200, (n, 7)), "zero": np.zeros((n, 7), int)}.get(kind, clustered(rng, n, 7))
    if kind == "copies":
        v[rng.random(n) < 0.4] = v[0]
    if kind == "scales":
        v = v * (10 ** rng.integers(0, 4, n))[:, None]
    ids, labels = rng.permutation(n) // (2 if kind == "copies" else 1), rng.integers(0, 4, n)
    tree = CoverTree(CoverTree.grow(ids, labels, v))
    assert sorted(map(tuple, tree.vectors.astype(int).tolist())) == sorted(map(tuple, v.tolist()))
    for q in range(0, n, 9):
        query = v[q].astype(float)
        everything = np.array([-np.inf]), np.array([np.inf])
        ((scores, found),) = tree.search(query, ids[q], labels[q], True, *everything, 5)
        assert list(zip(scores, found)) == plain(ids, labels, v, v[q], ids[q], labels[q], True, -np.inf, np.inf, 5)
        highs = np.array([scores[0] if len(scores) else 100.0, 50.0, 0.0])
        lows = np.ceil(highs * 0.8)
        for (s, i), low, high in zip(tree.search(query, ids[q], labels[q], False, lows, highs, 5), lows, highs):
            assert list(zip(s, i)) == plain(ids, labels, v, v[q], ids[q], labels[q], False, low, high, 5)


def test_nodes_are_covered_and_skipped(monkeypatch):
    monkeypatch.setattr(hardneg, "LEAF", 16)
    rng = np.random.default_rng(1)
    v = clustered(rng, 3000, 16)
    tree = CoverTree(CoverTree.grow(np.arange(3000), np.zeros(3000, int), v))

    def rows(node):
        if tree.leaf[node]:
            return list(range(tree.begin[node], tree.end[node]))
        return [r for c in range(tree.begin[node], tree.end[node]) for r in rows(c)]

    assert sorted(rows(0)) == list(range(3000))
    query, seen = v[5].astype(float), []
    for node in range(len(tree.leaf)):
        high, low = tree.bounds(query, float(np.sqrt(query @ query)), slice(node, node + 1))
        scores = tree.vectors[rows(node)] @ query
        assert low[0] <= scores.min() and scores.max() <= high[0]
    real = CoverTree.bounds
    monkeypatch.setattr(CoverTree, "bounds", lambda self, q, n, s: (seen.append(s.stop - s.start), real(self, q, n, s))[1])
    tree.search(query, 5, 0, True, np.array([-np.inf]), np.array([np.inf]), 5)
    assert sum(seen) < len(tree.leaf) / 3


@pytest.mark.parametrize("factor", [1, 20000])
def test_a_block_meets_a_node_together(monkeypatch, factor):
    monkeypatch.setattr(hardneg, "LEAF", 16)
    monkeypatch.setattr(hardneg, "HELD", 50)
    rng = np.random.default_rng(3)
    v = rng.integers(-200, 200, (900, 8)) * factor
    v[rng.random(900) < 0.1] = v[0]
    ids, labels = rng.permutation(900) // 2, rng.integers(0, 4, 900)
    trees = [CoverTree(CoverTree.grow(ids[a:b], labels[a:b], v[a:b])) for a, b in ((0, 500), (500, 900))]
    asked_for, real, seen = np.arange(0, 900, 3), CoverTree.bounds, []
    monkeypatch.setattr(CoverTree, "bounds", lambda self, q, n, s: (seen.append(1), real(self, q, n, s))[1])

    def block(same, lows, highs):
        asked = hardneg.Asked(v[asked_for].astype(float), ids[asked_for], labels[asked_for], same, lows, highs, 5)
        for tree in trees:
            tree.answer(asked)
        return asked

    everything = np.full((len(asked_for), 1), np.inf)
    first = block(True, -everything, everything)
    # Windows of which one is closed from the start.
    highs = np.column_stack([first.scores[:, 0, 0], first.scores[:, 0, 4] // 2, -everything])
    lows = np.column_stack([np.ceil(0.8 * highs[:, :2]), everything])
    second = block(False, lows, highs)
    for n, q in enumerate(asked_for):
        for asked, w, same, low, high in ((first, 0, True, -np.inf, np.inf), *((second, w, False, lows[n, w], highs[n, w]) for w in range(3))):
            got = [(s, i) for s, i in zip(asked.scores[n, w], asked.ids[n, w])][: asked.filled[n, w]]
            assert got == plain(ids, labels, v, v[q], ids[q], labels[q], same, low, high, 5)
    # Bounds are computed for many anchors at once: one by one it would be four times for each at the roots alone.
    assert len(seen) < 2 * len(asked_for)


def test_bins_have_a_task_each(spark):
    rng = np.random.default_rng(5)
    rows = [Row(vec_id=i, label=i % 3, embedding=rng.normal(0, 0.2, 4).tolist()) for i in range(320)]
    table = hardneg.candidates(spark.createDataFrame(rows).repartition(4, "vec_id"))
    trees = hardneg.index(table)
    anchors = table.filter("vec_id % 10 = 0").withColumn("anchor", F.col("vec_id"))
    anchors = anchors.select("*", F.array(F.lit(float("-inf"))).alias("lows"), F.array(F.lit(float("inf"))).alias("highs"))
    tasks = hardneg.dealt(trees, hardneg._blocks(anchors)).withColumn("task", F.spark_partition_id())
    assert trees.count() == 4
    assert [r["count"] for r in tasks.filter("kind = 0").groupBy("task").count().collect()] == [1] * 4
    assert hardneg.search(trees, anchors, True, 5).count() == 32 * 5


def expected(rows):
    known = []
    for r in rows:
        if None in (r.vec_id, r.label, r.embedding) or any(x is None or not math.isfinite(x) for x in r.embedding):
            continue
        known.append((r.vec_id, r.label, [math.floor(256 * x) for x in r.embedding]))
    out = Counter()
    for a, label, v in known:
        if a % 100:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: E731, B023
        order = lambda same: sorted(((score(w), i) for i, x, w in known if i != a and (x == label) == same and len(w) == len(v)), key=lambda t: (-t[0], t[1]))  # noqa: E731, B023
        negatives = order(False)
        for ps, p in order(True)[:5]:
            fit = [(s, i) for s, i in negatives if 80 * ps <= 100 * s <= 100 * ps]
            out.update((a, p, k + 1, i, ps, s) for k, (s, i) in enumerate(fit[:5]))
    return out


def test_mine(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        x = rng.normal(0, 0.2, 6)
        if i % 3 == 0:
            x = np.array([0.25, 0.1, -0.2, 0.3, 0.0, 0.1])
        rows.append(Row(vec_id=i, embedding=x.tolist(), label=int(rng.integers(0, 3)), score="clash"))
    rows += rows[100:103] + [Row(vec_id=i, embedding=[0.0] * 6, label=1, score="clash") for i in (1000, 1001)]
    odd = [None, [], [0.1], [0.1, None] * 3, [math.nan] * 6, [math.inf] * 6, [0.1] * 9]
    rows += [Row(vec_id=1100 + i, embedding=x, label=1, score="clash") for i, x in enumerate(odd * 2)]
    rows += [Row(vec_id=None, embedding=[0.5] * 6, label=1, score="x"), Row(vec_id=1300, embedding=[0.5] * 6, label=None, score="x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string")
    for n in (1, 5):
        found = hardneg.mine(hardneg.candidates(table.repartition(n)), F.col("vec_id") % 100 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert Counter(map(tuple, found.collect())) == expected(rows)
    assert len(expected(rows)) > 50


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hardneg.mine(hardneg.candidates(table), F.col("vec_id") % 100 == 0).count() == 0
