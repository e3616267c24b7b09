"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairngraph.llm import near_vectors as nv

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    size = {}
    for _, v, _ in rows:
        if v:
            size[len(v)] = size.get(len(v), 0) + 1
    dim = max(size, key=lambda d: (size[d], d)) if size else 0
    good = [i for i, (k, v, _) in enumerate(rows) if k is not None and v and len(v) == dim and None not in v and np.isfinite(v).all() and any(v)]
    out = {i: (r[0], 0, r[0], True) for i, r in enumerate(rows)}
    if not good:
        return list(out.values())
    x = np.array([rows[i][1] for i in good], np.float32).astype(float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    near = (x @ x.T >= cosine) & ~np.eye(len(x), dtype=bool)
    ids = np.array([rows[i][0] for i in good])
    least = ids.copy()
    while True:
        now = np.array([min(least[k], *least[near[k]]) if near[k].any() else least[k] for k in range(len(x))])
        if (now == least).all():
            break
        least = now
    for k, i in enumerate(good):
        out[i] = (int(ids[k]), int(near[k].sum()), int(least[k]), bool(ids[k] == least[k]))
    return list(out.values())


def cluster(rng, center, n, cosine):
    """`n` vectors at about `cosine` from `center`."""
    noise = rng.standard_normal((n, len(center)))
    noise -= np.outer(noise @ center, center)
    noise /= np.sqrt((noise * noise).sum(1, keepdims=True))
    return cosine * center + np.sqrt(1 - cosine * cosine) * noise


def given(dim, seed=4):
    rng = np.random.default_rng(seed)
    x = list(rng.standard_normal((300, dim)))
    for n, cosine in ((150, 0.998), (80, 0.96), (60, 0.94), (30, 0.99)):
        center = rng.standard_normal(dim)
        x += list(cluster(rng, center / np.sqrt(center @ center), n, cosine) * rng.uniform(0.01, 50))
    rows = [(int(i), [float(c) for c in v], int(i) % 3) for i, v in enumerate(x)]
    rows += [(900, rows[5][1], None), (901, rows[5][1], 1), (901, rows[5][1], 1), (902, rows[6][1], 2), (902, rows[7][1], 2)]
    rows += [(903, None, 1), (904, [], 1), (905, [0.0] * dim, 1), (906, [1.0] * (dim + 1), 1), (907, [None] + [1.0] * (dim - 1), 1)]
    rows += [(908, [float("nan")] + [1.0] * (dim - 1), 1), (909, [float("inf")] * dim, 1), (None, rows[0][1], 1), (None, None, None)]
    return rows


@pytest.mark.parametrize(("dim", "block"), [(64, 2048), (64, 16), (33, 16)])
def test_equals_brute_force(spark, rows, monkeypatch, dim, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    monkeypatch.setattr(nv, "MERGE", block)
    table = given(dim)
    expected = sorted(brute(table), key=repr)
    found = rows(nv.near_vectors(spark.createDataFrame(table, VECTORS).repartition(5)))
    assert found == expected
    assert max(r[1] for r in found) > 100


@pytest.mark.parametrize("dim", [1, 3, 5])
def test_few_dimensions(spark, rows, dim):
    """Everything is crowded; the threshold's pairs may be missed, but hardly any."""
    table = given(dim)
    expected, found = brute(table), rows(nv.near_vectors(spark.createDataFrame(table, VECTORS)))
    assert len(found) == len(expected)
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in expected)
    assert sum(r[1] for r in found) <= sum(r[1] for r in expected)


def test_clashing_columns_and_doubles(spark, rows):
    table = spark.createDataFrame(given(64), VECTORS)
    plain = rows(nv.near_vectors(table))
    more = table.withColumns({c: F.lit("x") for c in ("key", "split", "local", "class", "best", "size", "n_links", "kept", "a", "b", "component", "filter")})
    assert rows(nv.near_vectors(more)) == plain
    assert rows(nv.near_vectors(table.withColumn("embedding", F.col("embedding").cast("array<double>")))) == plain


def test_empty_and_single(spark, rows):
    assert nv.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(4, [1.0, 2.0], 1)], VECTORS)
    assert rows(nv.near_vectors(one)) == [(4, 0, 4, True)]
    none = spark.createDataFrame([(4, None, 1), (5, [0.0], 1)], VECTORS)
    assert rows(nv.near_vectors(none)) == [(4, 0, 4, True), (5, 0, 5, True)]


def test_filters_hold_pairs_at_the_threshold():
    """The cap filters alone: pairs at the threshold share one, and filters stay small as the table grows."""
    rng = np.random.default_rng(9)
    x = nv.units(rng.standard_normal((2000, 48)))
    y = np.concatenate([cluster(rng, v, 1, 0.9) for v in x])
    for n in (10_000, 1_000_000):
        filters = nv.Filters(n, 48, 0.9)
        (ra, ca, _), (rb, cb, _) = filters.decode(x), filters.decode(y)
        assert len(ra) == filters.count * len(x)
        total = filters.words**2
        shared = np.unique(np.intersect1d(ra * total + ca, rb * total + cb) // total)
        assert len(shared) >= 0.99 * len(x)
        assert n * filters.count / total < 30


def test_decoding_lists_the_nearest_directions():
    filters = nv.Filters(100, 8, 0.9)
    x = nv.units(np.random.default_rng(1).standard_normal((20, 8)))
    row, code, rank = filters.decode(x)
    y = nv.rotate(x, filters.seed)
    half = filters.width // 2
    product = (y[:, :half] @ filters.codes[0].T)[:, :, None] + (y[:, half:] @ filters.codes[1].T)[:, None, :]
    for r in range(20):
        best = np.argsort(-product[r].ravel(), kind="stable")[: filters.count]
        assert code[row == r].tolist() == best.tolist() and rank[row == r].tolist() == list(range(filters.count))
