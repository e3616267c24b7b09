"""Building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairngraph.session import cut

# Spark prunes `row_number() <= n` before the shuffle for n below this value
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_THRESHOLD = 1000
PRE_RANK_SALTS = 64


def top_n(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """The first `n` rows of every key group, exact, without moving a whole group to one task.

    Small `n`: the filter on `row_number()` lets Spark keep `n` rows per key in each map task
    (WindowGroupLimit). Large `n`: the same in two steps, the first one on salted groups.
    """
    rank = rank_col or "__rank"
    if n >= GROUP_LIMIT_THRESHOLD:
        salt = F.pmod(F.xxhash64(*_hashable(df)), F.lit(PRE_RANK_SALTS))
        salted = df.withColumn("__salt", salt)
        window = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = salted.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
        df = df.drop(rank, "__salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked if rank_col else ranked.drop(rank)


def _hashable(df: DataFrame) -> list[str]:
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return plain or df.columns


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key; duplicates are dropped before the shuffle."""
    return top_n(df, keys, order, 1)


def with_position(df: DataFrame, keys: Sequence[str], position: str = "position") -> DataFrame:
    """0-based position of every row in the order of the unique `keys`, over all partitions.

    Range-partitions by key, counts rows per range and adds each range's offset, so no task sees
    more than its range. The ranges are written once, since both passes have to agree on them.
    """
    ranged = cut(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()))
    per_range = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: bounded by the number of partitions.
    offsets = per_range.select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*keys))
    return (
        ranged.withColumn("__local", local)
        .join(F.broadcast(offsets), "__range")
        .withColumn(position, F.col("__offset") + F.col("__local") - 1)
        .drop("__range", "__local", "__offset")
    )


def grown(df: DataFrame) -> DataFrame:
    """`df` as a side of a join in which both sides grow with the input: both are shuffled, none is broadcast.

    What Spark estimates of derived rows (exploded, parsed, read from few bytes) can be a hundredth of their size, and a
    broadcast passes the driver whole.
    """
    return df.hint("merge")


def looked_up(df: DataFrame) -> DataFrame:
    """`df`, unique by the join's keys, as the side that rows are looked up in: both sides are shuffled, none is broadcast.

    Each task hashes its part of `df`, so the longer side is not sorted. Keys that repeat often belong in `grown`: a
    hash table cannot spill.
    """
    return df.hint("shuffle_hash")


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
