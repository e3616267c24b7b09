"""Exact nearest neighbours by cosine, and an inverted file of vector lists.

Vectors are packed: a row holds up to a few thousand vectors of one length as one matrix. Exact search meets every block of queries with
every block of stored vectors; the queries are broadcast in rounds of bounded size, so neither side has to fit anywhere.
A task hands on only its best k per query, and pairs never exist as rows.

The inverted file keeps the blocks of each list together, large lists in several. A query's vector goes to the lists of its
nearest centroids, and a join on the list reads just these: work falls with the number of probes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.operators.common import top_n, union_all
from cairngraph.session import cut, ship_with_tasks

ship_with_tasks(__name__)

QUERY_BLOCK = 2048
LIST_BLOCK = 4096
ROUND_BYTES = 64_000_000  # of query vectors or centroids that are broadcast at once
HELD = 200_000  # scored rows a task holds before it keeps the best
HITS = "query_id bigint, id bigint, similarity double"
PACKED = "dim int, n int, ids binary, cells binary"


def unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _by_length(batch: pa.RecordBatch, column: str = "embedding") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and unit vectors of the batch's rows; rows without a vector or with a null component are left out."""
    vectors = batch.column(column)
    length = np.asarray(pa.compute.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False))
    for dim in np.unique(length[length > 0]).tolist():
        at = np.flatnonzero(length == dim)
        values = vectors.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        matrix = np.asarray(values, np.float64).reshape(-1, dim)
        whole = ~np.isnan(matrix).any(axis=1)
        if whole.any():
            yield dim, at[whole], unit(matrix[whole])


def _packs(block: int, key: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(key).cast(pa.int64())
            for dim, at, matrix in _by_length(batch):
                for a in range(0, len(at), block):
                    some = at[a : a + block]
                    yield _pack_row(dim, ids.take(pa.array(some)).to_numpy(zero_copy_only=False), matrix[a : a + block])

    return run


def _pack_row(dim: int, ids: np.ndarray, matrix: np.ndarray, **more) -> pa.RecordBatch:
    return pa.record_batch(
        {
            **more,
            "dim": pa.array([dim], pa.int32()),
            "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "cells": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
        }
    )


def packed(vectors: DataFrame, block: int, key: str = "id") -> DataFrame:
    """(`key`, embedding) as rows of up to `block` unit vectors of one length. Rows without a key are left out."""
    rows = vectors.select(key, "embedding").filter(F.col(key).isNotNull())
    return rows.mapInArrow(_packs(block, key), PACKED)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the best `k` of every query; equal similarities are settled by id."""
    order = np.lexsort((ids, -score, query))
    start = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - start < k]


def _scored(k: int) -> Callable:
    """Rows of two packs -> the best `k` rows of the task for every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def kept() -> tuple[np.ndarray, ...]:
            query, ids, score = (np.concatenate(c) for c in zip(*held, strict=True))
            keep = _best(query, ids, score, k)
            return query[keep], ids[keep], score[keep]

        def out(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.record_batch(dict(zip(("query_id", "id", "similarity"), rows, strict=True)))

        for batch in batches:
            columns = ("dim", "ids", "cells", "q_ids", "q_cells")
            for dim, ids, cells, q_ids, q_cells in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                scores = np.frombuffer(q_cells).reshape(-1, dim) @ np.frombuffer(cells).reshape(-1, dim).T
                # only scores that reach the k-th best of their query are sorted
                few = min(k, len(ids))
                bar = np.partition(scores, -few, axis=1)[:, -few, None]
                query, row = np.nonzero(scores >= bar)
                score = scores[query, row]
                keep = _best(q_ids[query], ids[row], score, k)
                held.append((q_ids[query][keep], ids[row][keep], score[keep]))
                count += len(keep)
                if count > HELD:
                    rows = kept()
                    held, count = [rows], len(rows[0])
                    if count > HELD // 2:
                        yield out(rows)
                        held, count = [], 0
        if held:
            yield out(kept())

    return run


def _rounds(blocks: DataFrame) -> list[DataFrame]:
    """`blocks`, written once, in pieces of about `ROUND_BYTES` at most."""
    blocks = cut(blocks)
    size = blocks.agg(F.sum(F.octet_length("cells"))).head()[0] or 0
    count = max(1, -(-2 * size // ROUND_BYTES))
    if count == 1:
        return [blocks]
    turn = F.pmod(F.xxhash64("ids"), F.lit(count))
    return [blocks.filter(turn == r) for r in range(count)]


def knn(vectors: DataFrame, queries: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, id, similarity, rank) of the k nearest vectors. Both inputs: (id, embedding).

    Vectors of another length than the query's, null ones and those with null components are no neighbours. Any number of
    queries: each round of them scans the vectors once.
    """
    stored = packed(vectors, LIST_BLOCK)
    asked = packed(queries, block).select("dim", F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"), "ids", "cells")
    pieces = []
    rounds = _rounds(asked)
    for piece in rounds:
        # a stated set of queries against all vectors, in blocks, bounded by the round
        met = stored.join(F.broadcast(piece.select("dim", "q_ids", "q_cells")), "dim")
        hits = met.select("dim", "ids", "cells", "q_ids", "q_cells").mapInArrow(_scored(k), HITS)
        pieces.append(hits if len(rounds) == 1 else cut(hits))
    return _ranked(pieces, k)


def _ranked(pieces: list[DataFrame], k: int) -> DataFrame:
    return top_n(union_all(pieces), ["query_id"], [F.desc("similarity"), F.col("id")], k, "rank")


# --- inverted file --------------------------------------------------------------------------


def _centroid_rounds(centroids: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The centroids (list_id, embedding) piece by piece, each of bounded size."""
    for piece in _rounds(packed(centroids, LIST_BLOCK, "list_id")):
        table = piece.toArrow()
        for dim in np.unique(table.column("dim").to_numpy()).tolist() if table.num_rows else []:
            rows = table.filter(pa.compute.equal(table.column("dim"), dim))
            ids = np.concatenate([np.frombuffer(x, "<i8") for x in rows.column("ids").to_pylist()])
            cells = np.concatenate([np.frombuffer(x).reshape(-1, dim) for x in rows.column("cells").to_pylist()])
            order = np.argsort(ids, kind="stable")
            yield ids[order], cells[order], dim


def _nearest_lists(rows: DataFrame, key: str, centroids: DataFrame, n: int) -> DataFrame:
    """(`key`, list_id, similarity) of the `n` nearest lists of every row (`key`, embedding); ties go to the smaller list."""
    pieces = []
    for ids, matrix, dim in _centroid_rounds(centroids):
        shared = rows.sparkSession.sparkContext.broadcast((ids, matrix))

        def near(batches: Iterator[pa.RecordBatch], shared=shared, dim=dim) -> Iterator[pa.RecordBatch]:
            lists, centers = shared.value
            few = min(n, len(lists))
            for batch in batches:
                keys = batch.column(key)
                for length, at, matrix in _by_length(batch):
                    for a in range(0, len(at) if length == dim else 0, 1024):
                        scores = matrix[a : a + 1024] @ centers.T
                        best = np.argsort(-scores, axis=1, kind="stable")[:, :few]
                        row = np.repeat(np.arange(len(best)), few)
                        yield pa.record_batch(
                            {
                                key: keys.take(pa.array(at[a : a + 1024][row])),
                                "list_id": lists[best.ravel()],
                                "similarity": scores[row, best.ravel()],
                            }
                        )

        kind = dict(rows.dtypes)[key]
        pieces.append(rows.select(key, "embedding").filter(F.col(key).isNotNull()).mapInArrow(near, f"{key} {kind}, list_id bigint, similarity double"))
    if not pieces:
        return rows.select(key, F.lit(0).cast("bigint").alias("list_id"), F.lit(0.0).alias("similarity")).limit(0)
    if len(pieces) == 1:
        return pieces[0]
    return top_n(union_all([cut(p) for p in pieces]), [key], [F.desc("similarity"), F.col("list_id")], n)


def assign_lists(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """(id, embedding, list_id): each vector with the list of its nearest centroid. `centroids`: (list_id, embedding)."""
    near = _nearest_lists(vectors, "id", centroids, 1).select("id", "list_id")
    return vectors.select("id", "embedding").join(near.dropDuplicates(["id"]), "id")


def _list_packs(block: int) -> Callable:
    """Consecutive rows of a list, up to `block`, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, cells = None, [], []

        def out() -> pa.RecordBatch:
            return _pack_row(key[1], np.array(ids, np.int64), np.array(cells), list_id=pa.array([key[0]], pa.int64()))

        for batch in batches:
            lists, keys = batch.column("list_id").to_numpy(), batch.column("id").to_numpy()
            found = np.empty(batch.num_rows, object)
            for _, at, matrix in _by_length(batch):
                found[at] = list(matrix)
            for list_id, i, vector in zip(lists.tolist(), keys.tolist(), found, strict=True):
                if vector is None:
                    continue
                if ids and (key != (list_id, len(vector)) or len(ids) >= block):
                    yield out()
                    ids, cells = [], []
                key = (list_id, len(vector))
                ids.append(i)
                cells.append(vector)
        if ids:
            yield out()

    return run


def list_blocks(listed: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """(id, embedding, list_id) as the rows of an inverted file: (list_id, dim, n, ids, cells), in the order of the lists.

    Written as a table it can be read list by list. A list of any size is dealt over several tasks and blocks.
    """
    parts = listed.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / (4 * block)).alias("__parts"))
    large = parts.filter("__parts > 1")
    dealt = listed.select("id", "embedding", "list_id").filter("id is not null").join(large, "list_id", "left")
    part = F.pmod(F.xxhash64("id"), F.coalesce("__parts", F.lit(1)))
    dealt = dealt.withColumn("__part", part).drop("__parts").withColumn("__dim", F.size("embedding"))
    placed = dealt.repartitionByRange("list_id", "__part").sortWithinPartitions("list_id", "__dim")
    return placed.select("list_id", "id", "embedding").mapInArrow(_list_packs(block), f"list_id bigint, {PACKED}")


def probe_lists(
    blocks: DataFrame, queries: DataFrame, centroids: DataFrame, k: int, probes: int, block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, id, similarity, rank): the k nearest in the `probes` lists nearest to each query, from `list_blocks`."""
    probed = _nearest_lists(queries, "id", centroids, probes).select("id", "list_id")
    asked = queries.select("id", "embedding").join(probed, "id")
    packs = list_blocks(asked, block).select("list_id", "dim", F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    met = blocks.join(packs, ["list_id", "dim"]).select("dim", "ids", "cells", "q_ids", "q_cells")
    return _ranked([met.mapInArrow(_scored(k), HITS)], k)


def knn_lists(
    vectors: DataFrame, queries: DataFrame, k: int, centroids: DataFrame, probes: int, block: int = QUERY_BLOCK
) -> DataFrame:
    """Like `knn`, but a query only looks at the lists of its `probes` nearest centroids.

    `vectors` may come with a stored `list_id`; otherwise it is assigned on the way. For repeated searches, write
    `list_blocks` once and use `probe_lists`.
    """
    listed = vectors if "list_id" in vectors.columns else assign_lists(vectors, centroids)
    return probe_lists(cut(list_blocks(listed)), queries, centroids, k, probes, block)


def train_centroids(vectors: DataFrame, lists: int, sample: int = 100_000, rounds: int = 8, seed: int = 7) -> DataFrame:
    """(list_id, embedding) from spherical k-means over at most about `sample` vectors, drawn by a hash of the id.

    Each round assigns the sample and averages by list; only the bounded centroids pass the driver.
    """
    rows = vectors.select("id", "embedding").filter("id is not null and embedding is not null")
    total = rows.count()
    if total > sample:
        rows = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * sample / total))
    rows = cut(rows)
    first = rows.orderBy(F.xxhash64("id"), "id").limit(lists)
    centroids = cut(first.select(F.col("id").alias("list_id"), "embedding"))
    for _ in range(rounds):
        listed = assign_lists(rows, centroids)
        values = listed.select("list_id", F.posexplode("embedding").alias("pos", "v"))
        means = values.groupBy("list_id", "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
        ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
        centroids = cut(means.groupBy("list_id").agg(F.transform(ordered, lambda e: e["v"]).alias("embedding")))
    return centroids
