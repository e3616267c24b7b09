"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairngraph.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<float>, label int"
anchor = lambda: F.col("vec_id") % 10 == 0


def brute(rows, modulus=10, positives=5, k=10):
    size = {}
    for _, v, label in rows:
        if v and label is not None:
            size[len(v)] = size.get(len(v), 0) + 1
    dim = max(size, key=lambda d: (size[d], d)) if size else 0
    good = [r for r in rows if None not in r and len(r[1]) == dim and None not in r[1] and np.isfinite(r[1]).all()]
    cells = [[int(np.floor(256.0 * float(np.float32(c)))) for c in v] for _, v, _ in good]
    out, seen = [], set()
    for (a, v, label), x in zip(good, cells, strict=True):
        if a % modulus or (a, label, tuple(x)) in seen:
            continue
        seen.add((a, label, tuple(x)))
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for (i, _, other), y in zip(good, cells, strict=True) if i != a]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:k]
            out += [(a, i, rank + 1, n, -p, -s) for rank, (s, n, _) in enumerate(fits)]
    return sorted(out)


def given(dim, n=600, labels=4, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((8, dim))
    x = centers[rng.integers(0, 8, n)] + 0.7 * rng.standard_normal((n, dim))
    rows = [(i, [float(c) for c in np.round(v, 2) / 3], int(rng.integers(0, labels))) for i, v in enumerate(x)]
    rows = [(i, v, 0 if i % 3 == 0 else label) for i, v, label in rows]  # a third of all rows has one label
    rows += [(700 + i, rows[4][1], i % 2) for i in range(30)]  # ties
    rows += [(10, rows[10][1], rows[10][2]), (20, rows[21][1], 3), (41, rows[41][1], rows[41][2])] + [(43, rows[43][1], rows[43][2])] * 12
    rows += [(800, None, 1), (810, [], 1), (820, [0.0] * dim, 1), (830, [1.0] * (dim + 1), 1), (840, [None] + [1.0] * (dim - 1), 1)]
    rows += [(850, [float("nan")] * dim, 1), (860, [float("inf")] * dim, 1), (None, rows[0][1], 1), (870, rows[0][1], None), (None, None, None)]
    return rows


def found(spark, rows, table, **more):
    order = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return rows(hn.hard_negatives(spark.createDataFrame(table, VECTORS).repartition(4), anchor(), **more), *order)


@pytest.mark.parametrize(("dim", "block", "group"), [(16, 1024, 4096), (16, 32, 8), (5, 32, 4096), (1, 16, 8)])
def test_equals_brute_force(spark, rows, monkeypatch, dim, block, group):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "GROUP", group)
    monkeypatch.setattr(hn, "CHUNK", 7)
    table = given(dim)
    expected = sorted(brute(table), key=repr)
    assert len(expected) > 500
    assert found(spark, rows, table) == expected


def test_other_numbers(spark, rows):
    table = given(6, 200)
    assert found(spark, rows, table, positives=2, k=3) == sorted(brute(table, positives=2, k=3), key=repr)


def test_huge_components(spark, rows):
    table = [(i, [3e5 * (i - 7), 5e4 * (i % 4), 1.0], i % 2) for i in range(30)]
    assert found(spark, rows, table) == sorted(brute(table), key=repr)
    table += [(50, [3e38, -3e38, 3e38], 1), (60, [3e38, 1.0, 1.0], 0)]
    assert max(r[5] for r in found(spark, rows, table)) <= 2**62


def test_clashing_columns_and_empty_table(spark, rows):
    table = spark.createDataFrame(given(6, 200), VECTORS)
    more = table.withColumns({c: F.lit("x") for c in ("is_anchor", "place", "cells", "id", "pos", "score", "rank", "told", "block", "chunk")})
    assert rows(hn.hard_negatives(more, anchor())) == rows(hn.hard_negatives(table, anchor()))
    assert hn.hard_negatives(spark.createDataFrame([], VECTORS), anchor()).count() == 0
    assert hn.hard_negatives(table, F.lit(None).cast("boolean")).count() == 0
    assert hn.hard_negatives(table.filter("label = 0"), anchor()).count() == 0


def test_curve_is_a_hilbert_curve():
    """Every cell once, neighbours on the curve one step apart."""
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hn.hilbert(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_prune(spark, monkeypatch):
    rng = np.random.default_rng(2)
    a, x = rng.integers(-300, 300, (20, 9)), rng.integers(-300, 300, (50, 9))
    least, most = hn.bounds(a, x.min(0, keepdims=True).astype(float), x.max(0, keepdims=True).astype(float))
    score = hn.products(a, x)
    assert (least[:, 0] <= score.min(1)).all() and (most[:, 0] >= score.max(1)).all()
    # clustered vectors in few dimensions: most blocks are never read
    monkeypatch.setattr(hn, "BLOCK", 32)
    asked = []
    read = hn._Search.read
    monkeypatch.setattr(hn._Search, "read", lambda self, a, *r: asked.append((a.select(F.sum(F.size("asked"))).head()[0], self.blocks.count())) or read(self, a, *r))
    table = given(3, 3000)
    hn.hard_negatives(spark.createDataFrame(table, VECTORS), F.col("vec_id") % 100 == 0)
    anchors = len({r[0] for r in table if r[0] is not None and r[0] % 100 == 0})
    assert all(n < 0.5 * anchors * blocks for n, blocks in asked)
