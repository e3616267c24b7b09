"""Approximate nearest neighbours by cosine with cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its bucket is the nearest
signed axis, refined by the nearest signed axis of the first few coordinates of a second rotation. Every vector is
indexed in `tables` such tables. A query probes in each table the `probes` buckets with the least loss against its own; how many that
takes is measured on a bounded sample of queries against all rows, so the share of rows that is looked at falls as the table grows.

Index and queries travel as 16-bit sketches in blocks: a row holds all vectors of one map task and table that fall on one axis, so a
hot bucket is few rows, which an adaptive join splits. Each task scores blocks of candidates against blocks of queries and hands on
those that could be among the best, by bounds that hold whatever the rounding; their vectors are fetched once, and
the final scores are computed in double precision from them, summed in one fixed order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairngraph.llm.common import stored
from cairngraph.llm.registry import query, table
from cairngraph.llm.vectors import usual_length
from cairngraph.session import cut

QUERY_BLOCK = 512
SAMPLE = 128  # queries that the number of probes is measured on
RECALL = 0.96  # of their nearest rows that the probes have to reach
MOST_PROBES = 400  # where nothing can be measured
HELD = 400_000  # scored rows a task holds before it keeps the best per query


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    x, h = x.copy(), 1
    while h < d:
        pair = x.reshape(n, -1, 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.Generator(np.random.PCG64(seed)).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def _axes(x: np.ndarray, number: int, fine: int) -> tuple[np.ndarray, np.ndarray]:
    """Products with all signed axes, coarse and fine, of table `number`."""
    a, b = rotate(x, 2 * number), rotate(x, 2 * number + 1)[:, :fine]
    return np.concatenate([a, -a], 1), np.concatenate([b, -b], 1)


def _vectors(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors that take part: `dim` finite components, not all zero."""
    column = batch.column("embedding")
    right = pa.compute.equal(pa.compute.list_value_length(column), dim).fill_null(False)
    ids = batch.column("vec_id").filter(right)
    values = np.asarray(column.filter(right).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    x = values.reshape(-1, dim)
    good = np.isfinite(x).all(1) & (x != 0).any(1) & np.asarray(ids.is_valid())
    return ids.to_numpy(zero_copy_only=False)[good].astype(np.int64), x[good]


def _unit(x: np.ndarray, width: int) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def sketched(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit components of unit vectors, and their scale and greatest error as pairs of 32-bit numbers."""
    scale = (np.abs(x).max(1) / 32_000).astype(np.float32)
    scale = np.where(scale > 0, scale, np.float32(1e-30))
    code = np.clip(np.rint(x / scale[:, None].astype(np.float64)), -32_767, 32_767).astype("<i2")
    error = np.sqrt(((code * scale[:, None].astype(np.float64) - x) ** 2).sum(1)) * (1 + 1e-6) + 1e-9
    return code, np.stack([scale, np.nextafter(error.astype(np.float32), np.float32(2))], 1)


def _bounds(a: np.ndarray, a_more: np.ndarray, b: np.ndarray, b_more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest cosine of all pairs of sketched vectors."""
    one, other = (x * more[:, :1].astype(np.float64) for x, more in ((a, a_more), (b, b_more)))
    dot = one @ other.T
    e, f = a_more[:, 1].astype(np.float64)[:, None], b_more[:, 1].astype(np.float64)[None, :]
    room = e * (1 + f) + f * (1 + e) + e * f + 1e-9
    return dot - room, dot + room


def _index(dim: int, width: int, tables: int, fine: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _vectors(batch, dim)
            if not len(ids):
                continue
            unit = _unit(x, width)
            code, more = sketched(unit[:, :dim])
            for number in range(tables):
                coarse, small = _axes(unit, number, fine)
                axis, sub = coarse.argmax(1), small.argmax(1).astype(np.uint8)
                order = np.argsort(axis, kind="stable")
                edges = np.flatnonzero(np.append(True, np.diff(axis[order]) != 0))
                parts = np.split(order, edges[1:])
                yield pa.record_batch(
                    {
                        "number": np.full(len(parts), number, np.int32),
                        "axis": axis[order][edges].astype(np.int32),
                        "ids": pa.array([ids[p].tobytes() for p in parts], pa.binary()),
                        "subs": pa.array([sub[p].tobytes() for p in parts], pa.binary()),
                        "x": pa.array([code[p].tobytes() for p in parts], pa.binary()),
                        "x_more": pa.array([more[p].tobytes() for p in parts], pa.binary()),
                    }
                )

    return run


def _losses(unit: np.ndarray, number: int, fine: int) -> np.ndarray:
    """What a query loses in each bucket of a table against its own."""
    coarse, small = _axes(unit, number, fine)
    loss = (coarse.max(1, keepdims=True) - coarse)[:, :, None] ** 2
    return (loss + (small.max(1, keepdims=True) - small)[:, None, :] ** 2).reshape(len(unit), -1)


def _probes(dim: int, width: int, tables: int, fine: int, probes: int):
    """One row per query, table and axis probed; `subs` has a bit for each fine bucket to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _vectors(batch, dim)
            for at in range(0, len(ids), 256):
                some, y = ids[at : at + 256], x[at : at + 256]
                unit = _unit(y, width)
                code, more = sketched(unit[:, :dim])
                for number in range(tables):
                    loss = _losses(unit, number, fine)
                    count = min(probes, loss.shape[1])
                    chosen = np.argpartition(loss, count - 1, axis=1)[:, :count]
                    bits = np.zeros(loss.shape, bool)
                    bits[np.arange(len(some))[:, None], chosen] = True
                    bits = bits.reshape(len(some), 2 * width, -1)
                    row, axis = np.nonzero(bits.any(2))
                    masks = np.packbits(bits[row, axis], axis=1, bitorder="little")
                    yield pa.record_batch(
                        {
                            "number": np.full(len(row), number, np.int32),
                            "axis": axis.astype(np.int32),
                            "query": some[row],
                            "mask": pa.array([m.tobytes() for m in masks], pa.binary()),
                            "y": pa.array([code[r].tobytes() + more[r].tobytes() for r in row.tolist()], pa.binary()),
                        }
                    )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive queries of one table and axis, up to a fixed number, as one row."""
    key, held = None, []

    def packed():
        return pa.record_batch(
            {
                "number": pa.array([key[0]], pa.int32()),
                "axis": pa.array([key[1]], pa.int32()),
                "queries": pa.array([np.array([h[0] for h in held], np.int64).tobytes()], pa.binary()),
                "masks": pa.array([b"".join(h[1] for h in held)], pa.binary()),
                "ys": pa.array([b"".join(h[2] for h in held)], pa.binary()),
            }
        )

    for batch in batches:
        for number, axis, q, mask, y in zip(*(batch.column(c).to_pylist() for c in ("number", "axis", "query", "mask", "y")), strict=True):
            if held and (key != (number, axis) or len(held) >= QUERY_BLOCK):
                yield packed()
                held = []
            key = (number, axis)
            held.append((q, mask, y))
    if held:
        yield packed()


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, summed from the first component to the last: equal vectors give equal scores."""
    big = np.maximum(np.abs(x).max(1), np.abs(y).max(1)), np.minimum(np.abs(x).max(1), np.abs(y).max(1))
    if len(x) and (big[0].max() > 1e150 or big[1].min() < 1e-150):
        x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
    dot, xx, yy = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    for d in range(x.shape[1]):
        dot += x[:, d] * y[:, d]
        xx += x[:, d] * x[:, d]
        yy += y[:, d] * y[:, d]
    return dot / (np.sqrt(xx) * np.sqrt(yy))


def best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` best of every query, each vector once."""
    order = np.lexsort((v, -s, q))
    q, v = q[order], v[order]
    new = np.append(True, (q[1:] != q[:-1]) | (v[1:] != v[:-1]))[: len(q)]  # copies of a row score the same
    order, q = order[new], q[new]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1]))[: len(q)] if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def _scored(dim: int, fine: int, k: int):
    """The candidates that could be among the `k` best of a block, with bounds of their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def kept() -> tuple[np.ndarray, ...]:
            q, v, low, high = (np.concatenate(c) for c in zip(*held, strict=True))
            keep = hopeful(q, v, low, high, k)
            return q[keep], v[keep], low[keep], high[keep]

        def out(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.record_batch(dict(zip(("query_id", "vec_id", "low", "high"), rows, strict=True)))

        for batch in batches:
            columns = ("ids", "subs", "x", "x_more", "queries", "masks", "ys")
            for ids, subs, x, x_more, queries, masks, ys in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                ids, subs = np.frombuffer(ids, np.int64), np.frombuffer(subs, np.uint8)
                x, x_more = np.frombuffer(x, "<i2").reshape(-1, dim), np.frombuffer(x_more, "<f4").reshape(-1, 2)
                y = np.frombuffer(ys, np.uint8).reshape(-1, 2 * dim + 8)
                y, y_more = (np.ascontiguousarray(part).view(kind) for part, kind in ((y[:, : 2 * dim], "<i2"), (y[:, 2 * dim :], "<f4")))
                q = np.frombuffer(queries, np.int64)
                bits = np.unpackbits(np.frombuffer(masks, np.uint8).reshape(len(q), -1), axis=1, bitorder="little")
                probed = bits[:, : 2 * fine][:, subs].astype(bool) & (ids[None, :] != q[:, None])
                low, high = _bounds(y, y_more, x, x_more)
                low[~probed] = -3.0
                order = np.argsort(ids, kind="stable")
                start = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))[: len(ids)]
                if len(start) > k:  # what cannot be among the best `k` ids of the block is left out at once
                    by_id = np.maximum.reduceat(low[:, order], start, axis=1)
                    last = np.partition(by_id, len(start) - k, axis=1)[:, len(start) - k]
                    probed &= high >= last[:, None]
                i, j = np.nonzero(probed)
                if len(i):
                    held.append((q[i], ids[j], low[i, j], high[i, j]))
                    count += len(i)
                if count > HELD:
                    rows = kept()
                    held, count = [rows], len(rows[0])
                    if count > HELD // 2:
                        yield out(rows)
                        held, count = [], 0
        if held:
            yield out(kept())

    return run


def hopeful(q: np.ndarray, v: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Places of what could be among the `k` best of every query; of a query and vector one row."""
    order = np.lexsort((-low, v, q))
    q1, v1 = q[order], v[order]
    new = np.append(True, (q1[1:] != q1[:-1]) | (v1[1:] != v1[:-1]))[: len(q1)]
    # copies of an id count at their best, by either bound
    top = np.maximum.reduceat(high[order], np.flatnonzero(new)) if len(q1) else high
    one = order[new]
    first = best(q[one], v[one], low[one], k)
    rank_k = np.full(len(one), -3.0)
    group = np.unique(q[one], return_inverse=True)[1]
    counts = np.bincount(group[first], minlength=group.max() + 1 if len(group) else 0)
    least = np.full(len(counts), np.inf)
    np.minimum.at(least, group[first], low[one][first])
    rank_k = np.where(counts[group] >= k, least[group], -3.0)
    high[one] = top
    return one[top >= rank_k]


SCORED = "query_id long, vec_id long, low double, high double"


def _exact(dim: int):
    """Pairs with both vectors -> their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (
                np.asarray(batch.column(c).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
                for c in ("y", "x")
            )
            yield pa.record_batch({"query_id": batch.column("query_id"), "vec_id": batch.column("vec_id"), "score": cosines(one, other)})

    return run


def _finished(found: DataFrame, plain: DataFrame, dim: int, k: int) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the best `k`, from bounds of all that was found."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id"))
    placed = once.withColumn("r", place)
    last = F.max(F.when(F.col("r") == k, F.col("low"))).over(Window.partitionBy("query_id"))
    near = placed.withColumn("last", last).filter(F.col("high") >= F.coalesce("last", F.lit(-3.0))).select("query_id", "vec_id")
    # rows of an id that have a vector to compare
    whole = F.col("embedding").isNotNull() & (F.size("embedding") == dim)
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))) & F.exists("embedding", lambda v: v != 0)
    vectors = plain.filter(whole & finite)
    pairs = near.join(vectors.select("vec_id", F.col("embedding").alias("x")), "vec_id")
    pairs = pairs.join(vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("y")), "query_id")
    scored = pairs.select("query_id", "vec_id", "x", "y").mapInArrow(_exact(dim), "query_id long, vec_id long, score double")
    scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _packs(dim: int, fine: int, shards: int):
    """All vectors in rows of up to 4096, dealt in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            ids, x = _vectors(batch, dim)
            for at in range(0, len(ids), 4096):
                some = ids[at : at + 4096]
                code, more = sketched(_unit(x[at : at + 4096], dim))
                yield pa.record_batch(
                    {
                        "shard": pa.array([turn % shards], pa.int32()),
                        "ids": pa.array([some.tobytes()], pa.binary()),
                        "subs": pa.array([bytes(len(some))], pa.binary()),
                        "x": pa.array([code.tobytes()], pa.binary()),
                        "x_more": pa.array([more.tobytes()], pa.binary()),
                    }
                )
                turn += 1

    return run


def _asked(dim: int, fine: int):
    """Queries in rows of up to `QUERY_BLOCK`, that look into every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y = _vectors(batch, dim)
            for at in range(0, len(ids), QUERY_BLOCK):
                some = ids[at : at + QUERY_BLOCK]
                code, more = sketched(_unit(y[at : at + QUERY_BLOCK], dim))
                yield pa.record_batch(
                    {
                        "queries": pa.array([some.tobytes()], pa.binary()),
                        "masks": pa.array([b"\xff" * ((2 * fine + 7) // 8 * len(some))], pa.binary()),
                        "ys": pa.array([np.concatenate([code.view(np.uint8), more.view(np.uint8)], 1).tobytes()], pa.binary()),
                    }
                )

    return run


def _exactly(plain: DataFrame, queries: DataFrame, dim: int, fine: int, k: int, shards: int = 64) -> DataFrame:
    """The candidates of `queries` (few) among all rows, in blocks."""
    packs = plain.mapInArrow(_packs(dim, fine, shards), "shard int, ids binary, subs binary, x binary, x_more binary")
    blocks = queries.mapInArrow(_asked(dim, fine), "queries binary, masks binary, ys binary")
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = packs.join(blocks, "shard").select("ids", "subs", "x", "x_more", "queries", "masks", "ys")
    return found.mapInArrow(_scored(dim, fine, k), SCORED)


def probes_needed(plain: DataFrame, queries: DataFrame, dim: int, width: int, tables: int, fine: int, k: int) -> int:
    """How many buckets a query has to probe in each table to find nearly all of its `k` nearest rows.

    Measured on at most `SAMPLE` queries, those of least hash of the id, which are compared with all rows.
    """
    sample = cut(queries.filter("vec_id is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE))
    pairs = _finished(_exactly(plain, sample, dim, fine, k), plain, dim, k).filter("query_id <> vec_id")
    named = pairs.join(plain.select("vec_id", F.col("embedding").alias("x")), "vec_id").join(
        plain.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("y")), "query_id"
    )
    rows = named.select("x", "y").limit(4 * SAMPLE * k).toArrow()  # bounded by the sample
    x, y = (np.array([v for v in rows.column(c).to_pylist()], np.float64).reshape(-1, dim) for c in ("x", "y"))
    if not len(x):
        return MOST_PROBES
    a, b = _unit(x, width), _unit(y, width)
    need = np.full(len(x), np.iinfo(np.int64).max)
    for number in range(tables):
        coarse, small = _axes(a, number, fine)
        bucket = coarse.argmax(1) * 2 * fine + small.argmax(1)
        for at in range(0, len(b), 64):
            loss = _losses(b[at : at + 64], number, fine)
            own = np.take_along_axis(loss, bucket[at : at + 64, None], axis=1)
            need[at : at + 64] = np.minimum(need[at : at + 64], (loss <= own).sum(1))
    return int(np.quantile(need, RECALL, method="higher")) + 1


def nearest(
    vectors: DataFrame, is_query, k: int = 5, tables: int = 16, fine: int = 32, probes: int | None = None, dim: int | None = None
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest found among all other rows for every row with `is_query`.

    Vectors (`vec_id`, `embedding`) that are null, zero, of another length than `dim` (the most frequent, if not given) or
    hold null or non-finite components take no part, nor do rows with a null id. Ties go to the smaller id. Rows that share
    an id are one candidate at its best score, and no row is a candidate of its own id. Without `probes`, as many as
    `probes_needed` says. Queries whose buckets hold fewer than `k` candidates are compared with all rows, so only a table with
    fewer candidates gives fewer rows; an empty table gives none; other columns are ignored.
    """
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("vec_id is not null")
    if dim is None:
        dim = usual_length(plain)
    if dim <= 0:
        return plain.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(1 << (dim - 1).bit_length(), fine)
    queries = plain.filter("asks")
    if probes is None:
        probes = probes_needed(plain, queries, dim, width, tables, fine, k)
    index = plain.mapInArrow(_index(dim, width, tables, fine), "number int, axis int, ids binary, subs binary, x binary, x_more binary")
    asked = queries.mapInArrow(_probes(dim, width, tables, fine, probes), "number int, axis int, query long, mask binary, y binary")
    blocks = (
        asked.repartition("number", "axis")
        .sortWithinPartitions("number", "axis")
        .mapInArrow(_blocks, "number int, axis int, queries binary, masks binary, ys binary")
    )
    met = index.join(blocks, ["number", "axis"]).select("ids", "subs", "x", "x_more", "queries", "masks", "ys")
    found = stored(met.mapInArrow(_scored(dim, fine, k), SCORED))
    served = found.select("query_id", "vec_id").distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    wanting = queries.join(served, F.col("vec_id") == F.col("query_id"), "left_anti")
    rest = _exactly(plain, wanting, dim, fine, k)
    return _finished(found.unionByName(rest), plain, dim, k)


@query("op10_ann")
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
