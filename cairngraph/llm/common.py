"""Building blocks of the operators in this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairngraph.session import cut, shared_dir

MOST_BITS = 1 << 29


def part(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: the fixed folds of training and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def over_batches(step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Callable:
    """A `mapInArrow` function from a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return run


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(`a`, `b`) links of long ids -> (`id`, `component`), the least id reachable; only ids that occur in a link.

    Alternates two star contractions until no link changes: every id hangs itself, then its larger neighbours, on
    the least id around it. Each round is two aggregations over the links and needs no id on the driver; the number
    of rounds is logarithmic in the longest chain. A hub's links are reduced by map-side minimum and an adaptive
    join, never gathered as a list.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u is not null and v is not null and u <> v")
        .distinct()
    )
    sign = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.u", "e.v").filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError("components did not settle")
    # a star: every id has one link, to its least
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def perhaps_in(rows: DataFrame, key: str, members: DataFrame, flag: str = "perhaps") -> DataFrame:
    """`rows` with a boolean `flag`: false where the long `key` is certainly none of `members` (one column).

    A Bloom filter of one hash: sixteen bits a member, at most `MOST_BITS`, so that at most 64 MB are broadcast. Beyond that
    more rows are flagged, and none is missed. It keeps wide rows that a join would drop, or leave alone, out of its shuffle.
    """
    ids = members.select(F.col(members.columns[0]).cast("long").alias("id")).filter("id is not null")
    bits = min(MOST_BITS, max(1 << 15, 1 << (16 * ids.count() - 1).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits).cast("long"))
    bucket = lambda h: F.floor(h / (1 << 15)).cast("long")
    placed = ids.select(place(F.col("id")).alias("h"))
    filters = cut(placed.groupBy(bucket(F.col("h")).alias("_bucket")).agg(F.bitmap_construct_agg(F.col("h") % (1 << 15)).alias("_bits")))
    at = place(F.col(key))
    joined = rows.join(F.broadcast(filters), bucket(at) == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor((at % (1 << 15)) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.col(key).isNotNull() & F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn(flag, found).drop("_bucket", "_bits")


def hash_sample(rows: DataFrame, key: str, order: list[str], limits: Column) -> DataFrame:
    """Of each `key` at most `limits` rows, those of least hash of the columns `order`.

    Counts say up to which hash there are enough rows, so only about a third more than the limit get to the task that ranks a key,
    however many splits a hot key comes from.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    bound = counts.select(F.col(key).alias("_k"), ((1.3 * limits + 50) / F.col("_n") * float(1 << 30)).alias("_bound"))
    hashed = rows.withColumn("_h", F.xxhash64(*order))
    place = F.pmod(F.shiftrightunsigned("_h", 20), F.lit(1 << 30))
    low = hashed.join(bound, F.col(key).eqNullSafe(F.col("_k"))).filter(place < F.col("_bound"))
    first = Window.partitionBy(key).orderBy(F.pmod(F.shiftrightunsigned("_h", 20), F.lit(1 << 30)), "_h", *order)
    ranked = low.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= limits)
    return ranked.drop("_n", "_k", "_bound", "_h", "_r")


def by_group(keys: list[str], step: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """A `mapInArrow` function for partitions sorted by `keys`: `step` gets one whole group at a time.

    Only the group at hand is held; the caller bounds its size.
    """
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    yield from step(pa.Table.from_batches(held))
                    held = []
                last = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from step(pa.Table.from_batches(held))

    return run


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it again; unlike a checkpoint it is computed once."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def small_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of about `limit` bytes at most; a longer row is a batch of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def texts(docs: DataFrame) -> list[Column]:
    """`doc_id` as long and `text` as string; cast only where needed, so that equal inputs give equal plans."""
    kinds = dict(docs.dtypes)
    out = []
    for name, kind in (("doc_id", "bigint"), ("text", "string")):
        out.append(F.col(name) if kinds[name] == kind else F.col(name).cast(kind).alias(name))
    return out
