"""Hard negatives from candidate blocks on a Hilbert curve with zone maps.

Candidates are ordered by label and by their place on a Hilbert curve through all dimensions and written as Parquet blocks of
fixed size; each block's zone map holds its least and greatest component per dimension and its range of labels. Interval
arithmetic over a zone map bounds the inner products of an anchor with the whole block from both sides, so a block is read
for an anchor only if its interval meets one of the anchor's score windows above what has been found already.

An anchor first reads the few blocks of highest bound; what they hold raises the floor of its windows, and only then the rest is
chosen. Anchors travel in groups, neighbours on the curve together; zone maps in chunks. A group meets each chunk, and a
block that it has to read, once; tasks hand on the best rows of each window only. All arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairngraph.llm.common import stored
from cairngraph.llm.registry import query, table
from cairngraph.llm.vectors import good_rows, pieces, usual_length

BITS = 4  # of each component on the curve
BLOCK = 1024  # candidates of a block
GROUP = 4096  # anchors of a group
CHUNK = 4096  # zone maps of a chunk
SEEDS = 2  # blocks of highest bound that an anchor reads first
HELD = 400_000  # scored rows a task holds before it keeps the best
WIDEST = 2**62  # components and scores beyond this are cut to it
PACK = "id long, n int, ids binary, labels binary, kind string, cells binary, low binary, high binary, label_low long, label_high long"


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each row of `cells` (components below 2^bits) on the Hilbert curve, as bytes that sort like it."""
    n, d = cells.shape
    x = np.ascontiguousarray(cells.T.astype(np.int64))
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level
        for i in range(d):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(hit, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _coded(dim: int, scale: float):
    """Rows that take part, with whole components and their place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, dim):
                at, x = good_rows(batch, dim)
                named = batch.column("label").is_valid().to_numpy(zero_copy_only=False)[at]
                at, x = at[named], x[named]
                if not len(at):
                    continue
                with np.errstate(over="ignore"):
                    cells = np.clip(np.floor(256.0 * x), -WIDEST, WIDEST)
                place = np.clip((x / scale + 1) * 2 ** (BITS - 1), 0, 2**BITS - 1).astype(np.int64)
                keys = hilbert(place)[:, :64]
                yield pa.record_batch(
                    {
                        "vec_id": batch.column("vec_id").take(pa.array(at)),
                        "label": batch.column("label").take(pa.array(at)),
                        "is_anchor": batch.column("is_anchor").take(pa.array(at)),
                        "place": pa.array([k.tobytes() for k in keys], pa.binary()),
                        "cells": pa.array([c.tobytes() for c in cells.astype("<i8")], pa.binary()),
                    }
                )

    return run


def _packed(size: int):
    """Consecutive rows of a partition, `size` at a time, by id inside; with the zone map."""

    def pack(number: int, rows: pa.Table) -> pa.RecordBatch:
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        order = np.argsort(ids, kind="stable")
        cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), "<i8").reshape(len(ids), -1)[order]
        low, high = cells.min(0), cells.max(0)
        most = max(abs(int(low.min())), abs(int(high.max())))
        kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
        row = {
            "id": number, "n": len(ids), "ids": ids[order].astype("<i8").tobytes(), "labels": labels[order].astype("<i8").tobytes(),
            "kind": kind, "cells": cells.astype(kind).tobytes(), "low": low.astype("<f8").tobytes(), "high": high.astype("<f8").tobytes(),
            "label_low": int(labels.min()), "label_high": int(labels.max()),
        }
        types = {"id": pa.int64(), "n": pa.int32(), "kind": pa.string(), "label_low": pa.int64(), "label_high": pa.int64()}
        return pa.record_batch({k: pa.array([v], types.get(k, pa.binary())) for k, v in row.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, number = [], 0, None
        for batch in batches:
            if number is None and batch.num_rows:
                number = int(batch.column("split")[0].as_py()) << 32
            held.append(batch.select(["vec_id", "label", "cells"]))
            n += batch.num_rows
            while n >= size:
                rows = pa.Table.from_batches(held)
                yield pack(number, rows.slice(0, size))
                number, n = number + 1, n - size
                held = rows.slice(size).to_batches()
        if n:
            yield pack(number, pa.Table.from_batches(held))

    return run


def _laid_out(coded: DataFrame, rows: int, size: int) -> DataFrame:
    """`coded` as packs of `size` rows in the order of label and curve; ties of both are dealt by id."""
    order = ["label", "place", "vec_id"]
    ranged = coded.repartitionByRange(max(1, -(-rows // (16 * size))), *order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("split", F.spark_partition_id()).mapInArrow(_packed(size), PACK))


def _cells(row: dict, side: str) -> np.ndarray:
    return np.frombuffer(row[f"{side}cells"], row[f"{side}kind"]).reshape(row[f"{side}n"], -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a long cut to its ends."""
    most = [int(np.abs(m.astype(np.float64)).max()) if m.size else 0 for m in (a, b)]
    if most[0] * most[1] * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    found = a.astype(object) @ b.astype(object).T
    return np.clip(found, -WIDEST, WIDEST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of `a` with any vector between `low` and `high` (one row per block)."""
    a = a.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    wide = np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(wide < 2**50, 0, wide * 1e-12)  # whole numbers below are exact
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def top(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the `k` greatest scores of each row among those that are `ok`; of ties the first columns."""
    if score.shape[1] > k:
        last = -np.partition(-np.where(ok, score, -WIDEST - 1), k - 1, axis=1)[:, k - 1 : k]
        tie = ok & (score == last)
        ok = ok & (score > last)
        ok |= tie & (np.cumsum(tie, 1) <= k - ok.sum(1, keepdims=True))
    return np.nonzero(ok)


def _windows(told: list | None, n: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest wanted score by anchor and window; windows that an anchor doesn't have are empty."""
    low, high = np.full((n, count), WIDEST + 1), np.full((n, count), -WIDEST - 1)
    if told:
        at = np.array([(t["pos"], t["ordinal"]) for t in told])
        low[at[:, 0], at[:, 1]] = [t["low"] for t in told]
        high[at[:, 0], at[:, 1]] = [t["high"] for t in told]
    return low, high


def _zone_rows(row: dict) -> tuple[np.ndarray, ...]:
    zones = row["zones"]
    low, high = (np.array([np.frombuffer(z[c]) for z in zones]) for c in ("low", "high"))
    return np.array([z["block"] for z in zones]), low, high, np.array([z["label_low"] for z in zones]), np.array([z["label_high"] for z in zones])


def _first_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor of a group the blocks of a chunk with the highest bounds: of its own label (`same`) and of others."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block, low, high, first, last = _zone_rows(row)
            label = np.frombuffer(row["labels"], "<i8")[:, None]
            _, most = bounds(_cells(row, ""), low, high)
            for same in (True, False):
                fits = (first <= label) & (last >= label) if same else (first != label) | (last != label)
                rank = np.argsort(np.where(fits, -most, np.inf), axis=1, kind="stable")[:, :SEEDS]
                pos = np.repeat(np.arange(len(label)), rank.shape[1])
                column = rank.ravel()
                keep = fits[pos, column]
                pos, column = pos[keep], column[keep]
                yield pa.record_batch(
                    {
                        "id": np.full(len(pos), row["id"]),
                        "pos": pos.astype(np.int32),
                        "block": block[column],
                        "most": most[pos, column],
                        "same": np.full(len(pos), same),
                    }
                )


def _chosen(same: bool, windows: int):
    """The blocks of a chunk that a group has to read, each with the anchors that ask for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, low, high, first, last = _zone_rows(row)
                label = np.frombuffer(row["labels"], "<i8")[:, None]
                least, most = bounds(_cells(row, ""), low, high)
                fits = (first <= label) & (last >= label) if same else (first != label) | (last != label)
                floor, ceiling = _windows(row["told"], len(label), windows)
                met = np.zeros(fits.shape, bool)
                for w in range(windows):
                    met |= (most >= floor[:, w : w + 1]) & (least <= ceiling[:, w : w + 1])
                met &= fits
                some = np.flatnonzero(met.any(0))
                asked = [np.flatnonzero(met[:, b]).astype(np.int32) for b in some.tolist()]
                yield pa.record_batch(
                    {
                        "id": np.full(len(some), row["id"]),
                        "block": block[some],
                        "asked": pa.array(asked, pa.list_(pa.int32())),
                    }
                )

    return run


def _read(same: bool, windows: int, k: int):
    """The `k` best rows of a block in each window of the anchors that ask for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def kept() -> tuple[np.ndarray, ...]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            group, pos, ordinal, _, vec, score = columns
            order = np.lexsort((vec, -score, ordinal, pos, group))
            group, pos, ordinal = group[order], pos[order], ordinal[order]
            new = np.append(True, (group[1:] != group[:-1]) | (pos[1:] != pos[:-1]) | (ordinal[1:] != ordinal[:-1]))
            start = np.flatnonzero(new)
            rank = np.arange(len(order)) - start[np.cumsum(new) - 1]
            return tuple(c[order[rank < k]] for c in columns)

        def out(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.record_batch(dict(zip(("id", "pos", "ordinal", "anchor_id", "vec_id", "score"), rows, strict=True)))

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                asked = np.array(row["asked"])
                ids, labels = (np.frombuffer(row[c], "<i8")[asked] for c in ("ids", "labels"))
                others, their_labels = np.frombuffer(row["b_ids"], "<i8"), np.frombuffer(row["b_labels"], "<i8")
                score = products(_cells(row, "")[asked], _cells(row, "b_"))
                fits = (ids[:, None] != others) & ((labels[:, None] == their_labels) == same)
                floor, ceiling = _windows(row["told"], row["n"], windows)
                for w in range(windows):
                    ok = fits & (score >= floor[asked, w, None]) & (score <= ceiling[asked, w, None])
                    a, b = top(score, ok, k)
                    if len(a):
                        held.append((np.full(len(a), row["id"]), asked[a].astype(np.int32), np.full(len(a), w, np.int32), ids[a], others[b], score[a, b]))
                        count += len(a)
                if count > HELD:
                    rows = kept()
                    held, count = [rows], len(rows[0])
                    if count > HELD // 2:
                        yield out(rows)
                        held, count = [], 0
        if held:
            yield out(kept())

    return run


class _Search:
    """Groups of anchors against blocks of candidates."""

    def __init__(self, groups: DataFrame, blocks: DataFrame):
        chunks = -(-blocks.count() // CHUNK)
        zone = F.struct(F.col("id").alias("block"), "low", "high", "label_low", "label_high")
        zones = blocks.groupBy(F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(zone).alias("zones"))
        self.groups = groups.select("id", "n", "ids", "labels", "kind", "cells")
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))
        self.met = self.groups.withColumn("chunk", F.explode(numbers)).join(stored(zones), "chunk")
        self.blocks = blocks.select(F.col("id").alias("block"), *[F.col(c).alias(f"b_{c}") for c in ("n", "ids", "labels", "kind", "cells")])

    def first_blocks(self) -> DataFrame:
        """The blocks that each anchor reads first."""
        found = self.met.mapInArrow(_first_blocks, "id long, pos int, block long, most double, same boolean")
        order = Window.partitionBy("id", "pos", "same").orderBy(F.desc("most"), "block")
        return stored(found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SEEDS).drop("r", "most"))

    def read(self, asked: DataFrame, told: DataFrame, same: bool, windows: int, k: int) -> DataFrame:
        """The `k` best candidates in each window, of the blocks in `asked`."""
        rows = asked.join(self.blocks, "block").join(self.groups, "id").join(told, "id")
        found = rows.mapInArrow(_read(same, windows, k), "id long, pos int, ordinal int, anchor_id long, vec_id long, score long")
        order = Window.partitionBy("id", "pos", "ordinal").orderBy(F.desc("score"), "vec_id")
        return stored(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))

    def search(self, first: DataFrame, windows: DataFrame, same: bool, count: int, k: int) -> DataFrame:
        """The `k` best in each window (`id`, `pos`, `ordinal`, `low`, `high`)."""
        seeds = first.filter(F.col("same") == same).groupBy("id", "block").agg(F.collect_list("pos").alias("asked"))
        found = self.read(seeds, _told(windows), same, count, k)
        # k rows are there already, so only better ones are of interest
        floors = found.groupBy("id", "pos", "ordinal").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).drop("n")
        raised = windows.join(floors, ["id", "pos", "ordinal"], "left").withColumn("low", F.greatest("low", "floor")).drop("floor")
        told = stored(_told(raised))
        asked = self.met.join(told, "id").mapInArrow(_chosen(same, count), "id long, block long, asked array<int>")
        return self.read(asked, told, same, count, k)


def _told(windows: DataFrame) -> DataFrame:
    return windows.groupBy("id").agg(F.collect_list(F.struct("pos", "ordinal", "low", "high")).alias("told"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`: the first `k` negatives of every pair.

    `vectors` has `vec_id`, `embedding`, `label`. Components x become floor(256 * x); a row's score is its inner product with the anchor.
    An anchor's positives are the `positives` best other rows of its label, its negatives for each of them the best
    rows of another label between `low` and `high` percent of the positive's score; ties go to the smaller id. Rows with a null
    id, label or vector, with a vector of another length than the most frequent one or with null or non-finite components take no part.
    Rows that share an id are rows of their own, but none is a candidate of its own id; anchors alike in id, label and
    vector are one. Scores beyond 2^62 count as 2^62. An empty table gives no row; other columns are ignored.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    numbers = F.col("embedding").cast("array<double>")
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("label is not null")
    dim = usual_length(plain)
    if not dim:
        return vectors.sparkSession.createDataFrame([], schema)
    # the curve's cells divide what nearly all rows need; components beyond fall into the outer cells
    largest = F.array_max(F.transform("embedding", lambda v: F.when(F.abs(v) < 1e300, F.abs(v))))
    scale = plain.filter(F.size("embedding") == dim).agg(F.percentile_approx(largest, 0.99, 1000)).head()[0] or 1.0
    coded = stored(plain.mapInArrow(_coded(dim, scale), "vec_id long, label long, is_anchor boolean, place binary, cells binary"))
    anchors = coded.filter("is_anchor").dropDuplicates(["vec_id", "label", "cells"])
    groups = _laid_out(anchors, anchors.count(), GROUP)
    search = _Search(groups, _laid_out(coded, coded.count(), BLOCK))
    first = search.first_blocks()
    every = groups.select("id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos"), F.lit(0).alias("ordinal"))
    every = every.select("*", F.lit(-WIDEST).alias("low"), F.lit(WIDEST).alias("high"))
    found = search.search(first, every, True, 1, positives)
    near = found.select("id", "pos", (F.col("rank") - 1).alias("ordinal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # whole scores s with low * p <= 100 * s <= high * p
    share = lambda percent: (F.col("positive_score").cast("decimal(38,0)") * percent) / 100
    windows = near.select("id", "pos", "ordinal", F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high"))
    hard = search.search(first, windows.filter("low <= high"), False, positives, k)
    return hard.join(near, ["id", "pos", "ordinal"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank
from p join s on p.anchor_id = s.anchor_id and not s.same and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""


@query("op11_hard_negatives", ORACLE)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
