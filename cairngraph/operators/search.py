"""Node, edge and symbol filters, text search and visibility."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairngraph.functions.scalars import has_tag, matches_query, normalize_path
from cairngraph.operators.common import with_position
from cairngraph.session import ship_with_tasks

ship_with_tasks(__name__)

POSTING_SPAN = 65_536  # document numbers of a posting block

# Fixed value: the tag of code-graph rows.
CODE_TAG = "codeintel"
SYMBOL_ORDER = ("qualified_name", "file", "line")

# Words too common to be searched for.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then "
    "there these they this to was will with"
).split()
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


# --- nodes and edges ------------------------------------------------------------------------


def find_nodes(
    nodes: DataFrame,
    type: str | None = None,
    contains: str | None = None,
    exact: str | None = None,
    time_range: tuple | None = None,
    ephemeral: bool | None = None,
    limit: int | None = None,
    after: str | None = None,
    offset: int = 0,
) -> DataFrame:
    """Nodes by optional type, text, creation time and ephemeral flag; with a limit, that many in id order.

    A page goes on `after` the last id of the one before, which the scan filters by; `offset` counts rows instead, and
    sorts as many more.
    """
    found = nodes
    if type is not None:
        found = found.filter(F.col("type") == type)
    if exact is not None:
        found = found.filter(F.col("content") == exact)
    if contains is not None:
        found = found.filter(F.contains(F.lower("content"), F.lit(contains.lower())))
    if time_range is not None:
        found = found.filter(F.col("created_at").between(*time_range))
    if ephemeral is not None:
        found = found.filter(F.col("ephemeral") == ephemeral)
    if after is not None:
        found = found.filter(F.col("id") > after)
    if limit is None and not offset:
        return found
    found = found.orderBy("id")
    found = found.offset(offset) if offset else found
    return found if limit is None else found.limit(limit)


def find_edges(
    edges: DataFrame,
    source: str | None = None,
    target: str | None = None,
    type: str | None = None,
    min_weight: float | None = None,
) -> DataFrame:
    found = edges
    if source is not None:
        found = found.filter(F.col("src") == source)
    if target is not None:
        found = found.filter(F.col("dst") == target)
    if type is not None:
        found = found.filter(F.col("edge_type") == type)
    if min_weight is not None:
        found = found.filter(F.col("weight") >= min_weight)
    return found


def code_edges(edges: DataFrame, edge_type: str | None = None) -> DataFrame:
    """Code relations, of one kind if asked for. Tables that also hold other edges have `type`
    and `tags` columns, which are tested when present."""
    found = edges
    if "type" in edges.columns:
        found = found.filter(F.col("type") == "RELATED_TO")
    if "tags" in edges.columns:
        found = found.filter(has_tag("tags", CODE_TAG))
    return found if edge_type is None else found.filter(F.col("edge_type") == edge_type)


# --- symbols of active generations ----------------------------------------------------------


def in_project(df: DataFrame, project: str | None) -> DataFrame:
    """Rows of one project, whose path may be written in any way; all rows without one."""
    if project is None:
        return df
    return df.filter(F.col("project_path") == normalize_path(F.lit(project)))


def active_symbols(
    nodes: DataFrame,
    generations: DataFrame,
    project: str | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Symbols of active generations; all of them when there are no generations at all.

    With generations but no active one the result is empty. `project` limits both tables.
    """
    tagged = nodes.filter(has_tag("tags", CODE_TAG)) if "tags" in nodes.columns else nodes
    found, gens = in_project(tagged, project), in_project(generations, project)
    if kind is not None:
        found = found.filter(F.col("kind") == kind)
    any_generation = gens.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()
    active = (
        gens.filter(F.col("status") == "active")
        .select("generation_id")
        .distinct()
        .withColumn("__active", F.lit(True))
    )
    # One narrow row per index run: Spark broadcasts it when its size allows.
    joined = found.join(active, "generation_id", "left")
    kept = joined.filter(F.coalesce("__active", F.lit(False)) | ~any_generation)
    return kept.select(*nodes.columns)


def search(
    nodes: DataFrame,
    generations: DataFrame,
    query: str,
    project: str | None = None,
    kind: str | None = None,
    limit: int = 20,
) -> DataFrame:
    """Active symbols whose content and whose name, kind or language hold the text."""
    hits = active_symbols(nodes, generations, project, kind).filter(
        F.contains(F.lower("content"), F.lit(query.lower()))
        & matches_query(query, "name", "qualified_name", "kind", "language")
    )
    return hits.orderBy(*SYMBOL_ORDER, "id").limit(limit)


def suggest(nodes: DataFrame, prefix: str, type: str | None = None, limit: int = 5) -> DataFrame:
    """Contents starting with the prefix, most used first."""
    found = nodes.filter(F.col("content").startswith(prefix))
    if type is not None:
        found = found.filter(F.col("type") == type)
    return found.orderBy(F.desc("access_frequency"), "content", "id").limit(limit)


# --- full text ------------------------------------------------------------------------------


def tokens(content: str | Column) -> Column:
    """Distinct lower-case words without stop words."""
    words = F.filter(F.split(F.lower(content), TOKEN_SPLIT), lambda w: w != "")
    return F.array_except(words, F.array(*[F.lit(w) for w in STOP_WORDS]))


def text_match(nodes: DataFrame, query: str, content: str = "content") -> DataFrame:
    """Nodes that contain all words of the query, by reading every text. For a stored index see `match_blocks`."""
    wanted = tokens(F.lit(query))
    present = tokens(content)
    return nodes.filter(
        (F.size(wanted) > 0) & (F.size(F.array_except(wanted, present)) == 0)
    )


def numbered(nodes: DataFrame, key: str = "id") -> DataFrame:
    """(`key`, doc_no) with dense numbers in the order of the distinct keys, for keys that are no whole numbers."""
    return with_position(nodes.select(key).filter(F.col(key).isNotNull()).distinct(), [key], "doc_no")


def posting_blocks(nodes: DataFrame, key: str = "id", content: str = "content", span: int = POSTING_SPAN) -> DataFrame:
    """The inverted index: (token, block_no, n, first_id, last_id, deltas), sorted by token and block.

    A block holds the documents of one token in one range of `span` numbers, as the first one and the distances of the next.
    So a block is bounded however frequent its token is, and a token's documents come from many tasks. `first_id` and `last_id`
    let a reader skip blocks. Texts are read once. `key` must be a whole number (see `numbered`).
    """
    postings = nodes.select(F.col(key).cast("bigint").alias("id"), F.explode(tokens(content)).alias("token"))
    block = F.floor(F.col("id") / span).cast("bigint")
    # of repeated documents one counts
    lists = (
        postings.filter("id is not null")
        .withColumn("block_no", block)
        .groupBy("token", "block_no")
        .agg(F.array_sort(F.collect_set((F.col("id") - F.col("block_no") * span).cast("int"))).alias("__at"))
    )
    first = F.col("block_no") * span
    deltas = F.transform("__at", lambda x, i: F.when(i == 0, 0).otherwise(x - F.get("__at", i - 1)))
    return lists.repartitionByRange("token", "block_no").sortWithinPartitions("token", "block_no").select(
        "token",
        "block_no",
        F.size("__at").alias("n"),
        (first + F.element_at("__at", 1)).alias("first_id"),
        (first + F.element_at("__at", -1)).alias("last_id"),
        deltas.alias("deltas"),
    )


def token_frequencies(blocks: DataFrame) -> DataFrame:
    """(token, df, first_id, last_id) from the index alone."""
    return blocks.groupBy("token").agg(
        F.sum("n").cast("bigint").alias("df"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")
    )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of postings -> (token, id)."""
    for batch in batches:
        deltas = batch.column("deltas")
        length = np.asarray(pa.compute.list_value_length(deltas).to_numpy(zero_copy_only=False)).astype(np.int64)
        if not length.sum():
            continue
        total = np.cumsum(deltas.flatten().to_numpy().astype(np.int64))
        start = np.cumsum(length) - length
        row = np.repeat(np.arange(len(length)), length)
        ids = total - np.repeat(total[start], length) + batch.column("first_id").to_numpy()[row]
        yield pa.record_batch({"token": batch.column("token").take(pa.array(row)), "id": ids})


def block_ids(blocks: DataFrame) -> DataFrame:
    """(token, id) of all postings in `blocks`."""
    return blocks.select("token", "first_id", "deltas").mapInArrow(_decoded, "token string, id bigint")


def match_blocks(blocks: DataFrame, query: str) -> DataFrame:
    """(id) of the documents that contain all words of the query, from the index alone.

    The scan gets the words as a filter. Only ranges in which all words have blocks that overlap are decoded.
    """
    words = blocks.sparkSession.range(1).select(F.explode(tokens(F.lit(query)))).collect()  # the words of one question
    wanted = [row[0] for row in words]
    if not wanted:
        return blocks.select(F.col("first_id").alias("id")).limit(0)
    asked = blocks.filter(F.col("token").isin(wanted))
    if len(wanted) == 1:
        return block_ids(asked).select("id")
    ranges = asked.groupBy("block_no").agg(
        F.count(F.lit(1)).alias("__tokens"), F.max("first_id").alias("__low"), F.min("last_id").alias("__high")
    )
    ranges = ranges.filter((F.col("__tokens") == len(wanted)) & (F.col("__low") <= F.col("__high")))
    kept = asked.join(ranges.select("block_no"), "block_no", "left_semi")
    return block_ids(kept).groupBy("id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == len(wanted)).select("id")


# --- visibility and memories ----------------------------------------------------------------


def visible(tables: dict[str, DataFrame], user_id: str) -> dict[str, DataFrame]:
    """What a user may read: own and public brains, other tables only through own brains."""
    brains = tables["brains"]
    own = F.col("owner_id") == user_id
    owned = brains.filter(own).select(F.col("id").alias("brain_id")).distinct()
    result = {
        name: frame.join(owned, "brain_id", "left_semi").select(*frame.columns)
        for name, frame in tables.items()
        if name != "brains"
    }
    result["brains"] = brains.filter(own | F.coalesce("is_public", F.lit(False)))
    return result


def live_memories(
    memories: DataFrame,
    at: Column,
    type: str | None = None,
    project: str | None = None,
    min_trust: float | None = None,
) -> DataFrame:
    """Typed memories that have not expired."""
    found = memories.filter(F.col("expires_at").isNull() | (F.col("expires_at") > at))
    if type is not None:
        found = found.filter(F.col("memory_type") == type)
    if project is not None:
        found = found.filter(F.col("project_id") == project)
    if min_trust is not None:
        found = found.filter(F.col("trust_score") >= min_trust)
    return found

