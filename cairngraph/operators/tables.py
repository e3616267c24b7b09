"""Insert-ignore, upsert, snapshot merge and content dedupe on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairngraph.operators.common import first_by, grown

MERGE_STRATEGIES = ("prefer_local", "prefer_remote", "prefer_recent", "prefer_stronger")


def sortable(df: DataFrame, key: Sequence[str]) -> list[str]:
    """Columns that can break ties among rows of one key."""
    unsortable = (T.MapType, T.VariantType)
    plain = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, unsortable) and f.name not in key
    ]
    return plain or list(key)


def insert_ignore(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """`old` plus the rows of `new` with unknown keys; among equal new keys the first by `order`.

    Duplicates are dropped before the shuffle, so a key repeated in a third of the input costs
    no more than any other.
    """
    key = list(key)
    fresh = first_by(new, key, order or sortable(new, key))
    fresh = fresh.join(grown(old.select(*key)), key, "left_anti")
    return old.unionByName(fresh.select(*new.columns), allowMissingColumns=True)


def upsert(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows of `new` replace rows of `old` with the same key, all others are added."""
    key = list(key)
    fresh = first_by(new, key, order or sortable(new, key))
    kept = old.join(grown(fresh.select(*key)), key, "left_anti").select(*old.columns)
    return kept.unionByName(fresh.select(*new.columns), allowMissingColumns=True)


def merge_snapshots(
    local: DataFrame,
    incoming: DataFrame,
    strategy: str = "prefer_local",
    key: Sequence[str] = ("id",),
    recency: str = "updated_at",
    strength: str = "weight",
) -> tuple[DataFrame, DataFrame]:
    """(merged rows, one-row report). A conflict is one key with different content on both sides.

    The change time alone is no difference in content. Recent means the larger change time,
    stronger the larger weight, and a tie keeps the local row.
    """
    if strategy not in MERGE_STRATEGIES:
        raise ValueError(f"Unsupported strategy: {strategy}")
    paired = pair_snapshots(local, incoming, key, recency)
    mine, theirs = F.col("__local"), F.col("__incoming")
    wins = {
        "prefer_local": F.lit(False),
        "prefer_remote": F.lit(True),
        "prefer_recent": F.coalesce(theirs[recency] > mine[recency], F.lit(False))
        if recency in local.columns
        else F.lit(False),
        "prefer_stronger": F.coalesce(theirs[strength] > mine[strength], F.lit(False))
        if strength in local.columns
        else F.lit(False),
    }[strategy]
    take = mine.isNull() | (F.col("__conflict") & wins)
    merged = paired.select(F.when(take, theirs).otherwise(mine).alias("row")).select("row.*")
    both = mine.isNotNull() & theirs.isNotNull()
    report = paired.agg(
        F.count_if(mine.isNull()).alias("added"),
        F.count_if(both & take).alias("updated"),
        F.count_if(both & ~take).alias("skipped"),
        F.count_if("__conflict").alias("conflicts"),
    )
    return merged, report


def pair_snapshots(
    local: DataFrame, incoming: DataFrame, key: Sequence[str], recency: str = "updated_at"
) -> DataFrame:
    """Both sides as whole rows next to each other, with the conflict flag."""
    columns = local.columns
    content = [c for c in columns if c not in key and c != recency]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, F.struct(*columns).alias(name))

    joined = side(local, "__local").join(side(incoming, "__incoming"), list(key), "full_outer")
    mine = F.struct(*[F.col("__local")[c] for c in content])
    theirs = F.struct(*[F.col("__incoming")[c] for c in content])
    both = F.col("__local").isNotNull() & F.col("__incoming").isNotNull()
    return joined.withColumn("__conflict", both & ~mine.eqNullSafe(theirs))


def content_hash(content: str | Column) -> Column:
    """The stored 64-bit content hash."""
    return F.xxhash64(content)


def dedupe_content(
    nodes: DataFrame,
    tenant: str = "brain_id",
    content: str = "content",
    order: Sequence[str] = ("created_at", "id"),
) -> tuple[DataFrame, DataFrame]:
    """(kept nodes, one row per distinct content with its number of copies).

    Groups by a 256-bit digest, so texts do not travel through the shuffle, and copies are counted
    and the oldest chosen in each map task first. A null in `order` counts as later than any value; a null tenant or
    content is a value of its own. Rows alike in tenant, content and all of `order` cannot be told apart and all stay.
    """
    places = [x for c in order for x in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c).alias(c))]
    digest = F.sha2(F.col(content).cast("binary"), 256)
    groups = (
        nodes.select(tenant, digest.alias("digest"), *order)
        .groupBy(tenant, "digest")
        .agg(F.min(F.struct(*places)).alias("oldest"), F.count(F.lit(1)).alias("copies"))
        .select(tenant, "digest", *[F.col(f"oldest.{c}").alias(c) for c in order], "copies")
    )
    chosen = groups.select(*[F.col(c).alias(f"__{c}") for c in (tenant, "digest", *order)])
    marked = nodes.withColumn("__own", digest)
    same = marked["__own"].eqNullSafe(chosen["__digest"])
    for c in (tenant, *order):
        same = same & marked[c].eqNullSafe(chosen[f"__{c}"])
    return marked.join(chosen, same, "left_semi").drop("__own"), groups
