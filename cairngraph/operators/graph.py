"""Neighbours, callers, impact, paths and activation over edge tables.

Edges are (src, dst, edge_type, ...), nodes carry `id`. Loops go level by level with one join
per level; every level is written to the shared checkpoint folder before it is used again. The edge
table is scanned once per level, so it should be a stored table and not an expensive view.

Impact of many seeds goes by sets: seeds are numbered, and a row of a level is a node with 64 seeds as the bits of a long.
One row stands for up to 64 pairs of seed and node, and a level is one join and one OR. Shortest paths meet in the middle.
Where tables carry a tenant column (`brain_id`), ids hold within a tenant only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.functions.scalars import risk
from cairngraph.operators.common import first_by, grown, top_n, union_all, with_position
from cairngraph.operators.search import SYMBOL_ORDER, active_symbols, code_edges, in_project
from cairngraph.session import cut

# A frontier of at most this many rows and bytes of keys is sent to all tasks instead of shuffling the edges.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16_000_000
# At most this many start ids become a literal list that the scan can filter by.
LITERAL_IDS = 1000
SET = 64  # seeds of one row
TENANT = "brain_id"
CALLS = "CALLS"


def step_from(links: DataFrame, frontier: DataFrame, key: str, keys: list[str] | None = None) -> DataFrame:
    """`links` joined with a frontier on `key` (and further `keys` of both).

    Few rows: their keys also go to the scan as a literal filter. Up to a fixed number of rows and bytes the frontier
    is broadcast and the links are not shuffled. A larger one joins by shuffle, where the adaptive
    skew join splits the links of a hub.
    """
    size = frontier.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(key).cast("string")) + 32)).head()
    if size[0] <= LITERAL_IDS:
        found = [row[key] for row in frontier.select(key).distinct().collect()]
        links = links.filter(F.col(key).isin(found))
    small = size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_BYTES
    return links.join(F.broadcast(frontier) if small else frontier, keys or key)


def tenant_of(*frames: DataFrame) -> list[str]:
    """The tenant column, if all these tables have it."""
    return [TENANT] if all(TENANT in f.columns for f in frames) else []


def edges_at(edges: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Edges with one end in `ids`. Few ids become a filter the scan evaluates itself."""
    tenant = tenant_of(edges, ids)
    few = [row["id"] for row in ids.select("id").distinct().take(LITERAL_IDS + 1)]
    if len(few) <= LITERAL_IDS:
        edges = edges.filter(F.col(column).isin(few))
        if not tenant:
            return edges
    return edges.join(ids.select(F.col("id").alias(column), *tenant).distinct(), [column, *tenant], "left_semi")


# --- one step -------------------------------------------------------------------------------


def neighbors(
    nodes: DataFrame,
    edges: DataFrame,
    ids: DataFrame | None = None,
    direction: str = "both",
    types: Sequence[str] | None = None,
    min_weight: float | None = None,
) -> DataFrame:
    """(node_id, edge_type, weight, direction, neighbour columns) around `ids`, or all nodes.

    Direction both gives a self-loop twice. If nodes and edges have a tenant, neighbours are of the edge's tenant, and
    `ids` may name one, too.
    """
    tenant = tenant_of(nodes, edges)
    used = edges
    if types:
        used = used.filter(F.col("edge_type").isin(*types))
    if min_weight is not None:
        used = used.filter(F.col("weight") >= min_weight)
    sides = []
    for name, here, there in (("out", "src", "dst"), ("in", "dst", "src")):
        if direction not in (name, "both"):
            continue
        side = used if ids is None else edges_at(used, ids, here)
        sides.append(
            side.select(
                *tenant,
                F.col(here).alias("node_id"),
                F.col(there).alias("id"),
                "edge_type",
                "weight",
                F.lit(name).alias("direction"),
            )
        )
    return union_all(sides).join(nodes, ["id", *tenant])


def linked_symbols(
    nodes: DataFrame,
    edges: DataFrame,
    starts: DataFrame,
    direction: str,
    limit: int,
) -> DataFrame:
    """Call neighbours of each seed's start nodes: one row per symbol, the first `limit` per seed.

    `starts`: (seed, id).
    """
    here, there = ("dst", "src") if direction == "in" else ("src", "dst")
    calls = code_edges(edges, CALLS).select(F.col(here).alias("id"), F.col(there).alias("__other"))
    pairs = starts.select("seed", "id").join(calls, "id").select("seed", F.col("__other").alias("id"))
    found = pairs.join(nodes, "id")
    once = first_by(found, ["seed", "symbol_id"], ["id"])
    return top_n(once, ["seed"], [*SYMBOL_ORDER, "id"], limit, "rank")


def start_nodes(
    nodes: DataFrame, generations: DataFrame, symbol: str, project: str | None = None
) -> DataFrame:
    active = active_symbols(nodes, generations, project)
    return active.filter(F.col("symbol_id") == symbol).select(
        F.lit(symbol).alias("seed"), "id"
    )


def _linked(nodes, edges, generations, symbol, project, limit, direction) -> DataFrame:
    starts = start_nodes(nodes, generations, symbol, project)
    here = "dst" if direction == "in" else "src"
    near = edges_at(code_edges(edges, CALLS), starts, here)
    found = linked_symbols(in_project(nodes, project), near, starts, direction, limit)
    return found.select(*nodes.columns).orderBy(*SYMBOL_ORDER, "id")


def callers(nodes, edges, generations, symbol_id, project=None, limit=20) -> DataFrame:
    """Active symbols that call the symbol."""
    return _linked(nodes, edges, generations, symbol_id, project, limit, "in")


def callees(nodes, edges, generations, symbol_id, project=None, limit=20) -> DataFrame:
    """Symbols that the active symbol calls."""
    return _linked(nodes, edges, generations, symbol_id, project, limit, "out")


def callers_batch(nodes, edges, seeds, limit=20) -> DataFrame:
    """Callers for a table of seeds (seed, id), `limit` per seed."""
    return linked_symbols(nodes, edges, seeds, "in", limit)


def callees_batch(nodes, edges, seeds, limit=20) -> DataFrame:
    """Callees for a table of seeds (seed, id), `limit` per seed."""
    return linked_symbols(nodes, edges, seeds, "out", limit)


# --- impact ---------------------------------------------------------------------------------


def impact_batch(
    nodes: DataFrame,
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = 3,
    max_results: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Who is affected by each seed, found by going up the call edges level by level.

    `seeds`: (seed, id), several start nodes per seed allowed. Returns the affected symbols
    (seed, depth, node columns) and per seed (affected_symbols, affected_files, truncated,
    total_visited, risk). Everything is reported, unless a caller sets `max_results`: then within a level
    nodes are taken by qualified name, file, line and symbol id, and a node beyond the cap counts as visited and is neither
    reported nor followed; `truncated` says so.
    """
    calls = code_edges(edges, CALLS).select(F.col("dst").alias("id"), F.col("src").alias("caller"))
    if max_results is None:
        visited, kept_levels = _levels_by_sets(calls, seeds, max_depth)
    else:
        visited, kept_levels = _levels_by_cap(nodes, calls, seeds, max_depth, max_results)
    symbols = _affected(kept_levels, nodes, seeds)
    return symbols, _impact_summary(seeds, symbols, visited, kept_levels)


def seed_sets(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seed, id) -> start nodes as rows (id, block, bits), and the number of every seed (seed, block, bit)."""
    numbers = with_position(seeds.select("seed").distinct(), ["seed"])
    block, bit = F.floor(F.col("position") / SET).cast("bigint"), (F.col("position") % SET).cast("int")
    numbers = cut(numbers.select("seed", block.alias("block"), bit.alias("bit")))
    one = F.expr("shiftleft(cast(1 as bigint), bit)")
    starts = seeds.select("seed", "id").distinct().join(numbers, "seed")
    return starts.groupBy("id", "block").agg(F.bit_or(one).alias("bits")), numbers


def reach_sets(calls: DataFrame, starts: DataFrame, max_depth: int) -> list[DataFrame]:
    """The levels of a search from all seeds at once, the start first: rows (id, block, bits) of the seeds that get to a node then."""
    levels = [cut(starts)]
    seen = levels[0]
    for _ in range(max_depth):
        reached = step_from(calls, levels[-1], "id").groupBy(F.col("caller").alias("id"), "block").agg(F.bit_or("bits").alias("bits"))
        before = seen.select("id", "block", F.col("bits").alias("__seen"))
        joined = reached.join(before, ["id", "block"], "left")
        fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("__seen", F.lit(0).cast("bigint"))))
        level = cut(joined.select("id", "block", fresh.alias("bits")).filter("bits <> 0"))
        if level.isEmpty():
            break
        levels.append(level)
        seen = cut(seen.unionByName(level).groupBy("id", "block").agg(F.bit_or("bits").alias("bits")))
    return levels


def _levels_by_sets(calls: DataFrame, seeds: DataFrame, max_depth: int) -> tuple[list[DataFrame], list[DataFrame]]:
    starts, numbers = seed_sets(seeds)
    levels = reach_sets(calls, starts, max_depth)
    bits = F.filter(F.sequence(F.lit(0), F.lit(SET - 1)), lambda b: F.getbit(F.col("bits"), b) == 1)
    pairs = [level.select("id", "block", F.explode(bits).alias("bit")).join(numbers, ["block", "bit"]).select("seed", "id") for level in levels]
    kept = [pair.withColumn("depth", F.lit(depth)) for depth, pair in enumerate(pairs) if depth]
    return pairs, kept


def _levels_by_cap(
    nodes: DataFrame, calls: DataFrame, seeds: DataFrame, max_depth: int, max_results: int
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Pair by pair, since a cap cuts the levels of each seed on its own."""
    frontier = cut(seeds.select("seed", "id").distinct())
    visited = [frontier]
    kept_levels: list[DataFrame] = []
    for depth in range(1, max_depth + 1):
        reached = step_from(calls, frontier, "id").select("seed", F.col("caller").alias("id")).distinct()
        fresh = cut(reached.join(union_all(visited), ["seed", "id"], "left_anti"))
        if fresh.isEmpty():
            break
        visited.append(fresh)
        frontier = cut(_within_cap(fresh, nodes, kept_levels, max_results))
        kept_levels.append(frontier.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
    return visited, kept_levels


def _within_cap(
    fresh: DataFrame, nodes: DataFrame, kept_levels: list[DataFrame], max_results: int
) -> DataFrame:
    """The level's first nodes in symbol order, as many as the seed's cap still allows."""
    order = [*SYMBOL_ORDER, "symbol_id", "id"]
    described = fresh.join(nodes.select("id", *SYMBOL_ORDER, "symbol_id"), "id")
    # No seed keeps more than the cap, so this bound is applied before the shuffle.
    ranked = top_n(described, ["seed"], order, max_results, "__rank")
    if not kept_levels:
        return ranked.select("seed", "id")
    used = union_all(kept_levels).groupBy("seed").agg(F.count(F.lit(1)).alias("__used"))
    left = F.lit(max_results) - F.coalesce("__used", F.lit(0))
    return ranked.join(used, "seed", "left").filter(F.col("__rank") <= left).select("seed", "id")


def _affected(kept_levels: list[DataFrame], nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    if not kept_levels:
        return seeds.select("seed", "id", F.lit(0).alias("depth")).limit(0).join(nodes, "id")
    found = union_all(kept_levels).join(nodes, "id")
    return first_by(found, ["seed", "symbol_id"], ["depth", "id"])


def _impact_summary(seeds, symbols, visited, kept_levels) -> DataFrame:
    n = F.count(F.lit(1))
    seen = union_all(visited).groupBy("seed").agg(n.alias("total_visited"))
    first = visited[0].groupBy("seed").agg(n.alias("starts"))
    totals = seeds.select("seed").distinct().join(seen, "seed", "left").join(first, "seed", "left")
    if kept_levels:
        kept = union_all(kept_levels).groupBy("seed").agg(n.alias("kept"))
        totals = totals.join(kept, "seed", "left")
    else:
        totals = totals.withColumn("kept", F.lit(0))
    found = symbols.groupBy("seed", "file").agg(n.alias("in_file")).groupBy("seed").agg(
        F.sum("in_file").alias("affected_symbols"), n.alias("affected_files")
    )
    zero = F.lit(0)
    return totals.join(found, "seed", "left").select(
        "seed",
        F.coalesce("affected_symbols", zero).alias("affected_symbols"),
        F.coalesce("affected_files", zero).alias("affected_files"),
        (
            F.coalesce("total_visited", zero) - F.coalesce("starts", zero)
            > F.coalesce("kept", zero)
        ).alias("truncated"),
        F.coalesce("total_visited", zero).alias("total_visited"),
        risk(F.coalesce("affected_symbols", zero)).alias("risk"),
    )


def impact(
    nodes: DataFrame,
    edges: DataFrame,
    generations: DataFrame,
    symbol_id: str,
    project: str | None = None,
    max_depth: int = 3,
    max_results: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Impact of one active symbol: (affected symbols, one-row summary).

    An unknown symbol gives no symbols and a summary with nothing visited. With a project,
    callers elsewhere are neither counted nor followed.
    """
    starts = start_nodes(nodes, generations, symbol_id, project)
    if project is not None:
        nodes = in_project(nodes, project)
        edges = edges.join(nodes.select(F.col("id").alias("src")), "src", "left_semi")
    symbols, summary = impact_batch(nodes, edges, starts, max_depth, max_results)
    asked = nodes.sparkSession.range(1).select(F.lit(symbol_id).alias("seed"))
    whole = asked.join(summary, "seed", "left").select(
        "seed",
        F.coalesce("affected_symbols", F.lit(0)).alias("affected_symbols"),
        F.coalesce("affected_files", F.lit(0)).alias("affected_files"),
        F.coalesce("truncated", F.lit(False)).alias("truncated"),
        F.coalesce("total_visited", F.lit(0)).alias("total_visited"),
        F.coalesce("risk", F.lit("low")).alias("risk"),
    )
    return symbols.orderBy(*SYMBOL_ORDER, "symbol_id"), whole


# --- paths and activation -------------------------------------------------------------------


def shortest_path(
    edges: DataFrame, pairs: DataFrame, max_hops: int = 4, bidirectional: bool = False
) -> DataFrame:
    """(src, dst, hops, path) for the pairs (src, dst) that are connected within `max_hops`.

    Among equally short paths the one with the smallest ids from the start on. `bidirectional`
    also walks edges against their direction. The search goes from both ends in turn and stops for a pair as soon as they
    meet; levels hold nodes, not paths, and paths are put together for the pairs that met.
    """
    step = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    if bidirectional:
        step = step.unionByName(step.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pair = ["src", "dst"]
    open_pairs = cut(pairs.select(*pair).filter("src is not null and dst is not null").distinct())
    ahead = [open_pairs.select(*pair, F.col("src").alias("node"))]
    back = [open_pairs.select(*pair, F.col("dst").alias("node"))]
    met: list[tuple[int, DataFrame]] = []

    def meet(hops: int) -> bool:
        """Settle the pairs whose ends meet now; whether any is left open."""
        nonlocal open_pairs
        found = cut(ahead[-1].join(back[-1], [*pair, "node"], "left_semi"))
        if not found.isEmpty():
            met.append((hops, found))
            open_pairs = cut(open_pairs.join(found.select(*pair).distinct(), pair, "left_anti"))
        return not open_pairs.isEmpty()

    def grow(levels: list[DataFrame], here: str, there: str) -> None:
        links = step.select(F.col(here).alias("node"), F.col(there).alias("next"))
        frontier = levels[-1].join(open_pairs, pair, "left_semi")
        fresh = step_from(links, frontier, "node").select(*pair, F.col("next").alias("node")).distinct()
        levels.append(cut(fresh.join(union_all(levels), [*pair, "node"], "left_anti")))

    going = meet(0)
    for hops in range(1, max_hops + 1):
        if not going:
            break
        if hops % 2:
            grow(ahead, "a", "b")
        else:
            grow(back, "b", "a")
        going = meet(hops)
    found = [_paths(step, ahead, back, hops, middle) for hops, middle in met]
    if not found:
        none = pairs.select(*pair).limit(0)
        return none.select(*pair, F.lit(0).alias("hops"), F.array("src").alias("path"))
    return union_all(found)


def _paths(step: DataFrame, ahead: list[DataFrame], back: list[DataFrame], hops: int, middle: DataFrame) -> DataFrame:
    """The smallest path of each pair that met in `middle` after `hops` steps."""
    pair = ["src", "dst"]
    here = (hops + 1) // 2  # steps from the start to the middle
    links = step.select(F.col("a").alias("node"), F.col("b").alias("next"))
    # nodes on shortest paths, place by place: towards the start, then towards the end
    places = {here: middle}
    for at in range(here - 1, -1, -1):
        after = places[at + 1].withColumnRenamed("node", "next")
        before = step_from(links.select("next", "node"), after, "next").select(*pair, "node").distinct()
        places[at] = cut(before.join(ahead[at], [*pair, "node"], "left_semi"))
    for at in range(here + 1, hops + 1):
        after = step_from(links, places[at - 1], "node").select(*pair, F.col("next").alias("node")).distinct()
        places[at] = cut(after.join(back[hops - at], [*pair, "node"], "left_semi"))
    path = middle.select(*pair).distinct().select(*pair, F.col("src").alias("node"), F.array("src").alias("path"))
    for at in range(1, hops + 1):
        walked = step_from(links, cut(path), "node").select(*pair, "path", F.col("next").alias("node"))
        allowed = walked.join(places[at], [*pair, "node"], "left_semi")
        path = allowed.groupBy(*pair).agg(F.min("node").alias("node"), F.first("path").alias("path"))
        path = path.select(*pair, "node", F.concat("path", F.array("node")).alias("path"))
    return path.select(*pair, F.lit(hops).alias("hops"), "path")


def spread(
    edges: DataFrame, seeds: DataFrame, hops: int, decay: float, threshold: float
) -> DataFrame:
    """(id, activation, first_round): seeds (id, level) pass their level on along weighted edges.

    Each round a node receives the sum of level times weight, times `decay`; what stays below
    `threshold` is dropped. A node's activation is the sum of all it received, seeds included. If edges and seeds have a
    tenant, levels pass along edges of their own tenant and are summed per tenant.
    """
    tenant = tenant_of(edges, seeds)
    links = edges.select(*tenant, F.col("src").alias("id"), "dst", "weight")
    level = cut(seeds.select(*tenant, "id", F.col("level").cast("double").alias("level")))
    rounds = [level.withColumn("round", F.lit(0))]
    for number in range(1, hops + 1):
        if level.isEmpty():
            break
        received = (
            step_from(links, level, "id", ["id", *tenant])
            .groupBy(*tenant, F.col("dst").alias("id"))
            .agg((F.sum(F.col("level") * F.col("weight")) * decay).alias("level"))
            .filter(F.col("level") >= threshold)
        )
        level = cut(received)
        rounds.append(level.withColumn("round", F.lit(number)))
    return union_all(rounds).groupBy(*tenant, "id").agg(
        F.sum("level").alias("activation"), F.min("round").alias("first_round")
    )


# --- fibers and edge checks -----------------------------------------------------------------


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends exist, in the edge's tenant if nodes and edges have one."""
    tenant = tenant_of(nodes, edges)
    ids = nodes.select("id", *tenant)
    kept = edges.join(grown(ids.withColumnRenamed("id", "src")), ["src", *tenant], "left_semi")
    kept = kept.join(grown(ids.withColumnRenamed("id", "dst")), ["dst", *tenant], "left_semi")
    return kept.select(*edges.columns)


def recall_detail(
    fibers: DataFrame, nodes: DataFrame, memories: DataFrame, asked: DataFrame | None = None
) -> DataFrame:
    """Fiber, its anchor node's content and its typed memory if any, with a status.

    `asked` (brain_id, fiber_id) reports unknown fibers too; without it all fibers are shown. Nodes with a tenant anchor
    fibers of their own tenant only.
    """
    paths = fibers.select("brain_id", F.col("id").alias("fiber_id"), "anchor_neuron_id")
    if asked is not None:
        paths = asked.join(
            paths.withColumn("__known", F.lit(True)), ["brain_id", "fiber_id"], "left"
        )
    else:
        paths = paths.withColumn("__known", F.lit(True))
    tenant = tenant_of(nodes)
    anchors = nodes.select(
        *tenant, F.col("id").alias("anchor_neuron_id"), "content", F.lit(True).alias("__anchored")
    )
    typed = memories.select("brain_id", "fiber_id", "memory_type", "priority")
    return (
        paths.join(anchors, ["anchor_neuron_id", *tenant], "left")
        .join(typed, ["brain_id", "fiber_id"], "left")
        .select(
            "brain_id",
            "fiber_id",
            "anchor_neuron_id",
            "content",
            "memory_type",
            "priority",
            F.when(F.col("__known").isNull(), F.lit("fiber not found"))
            .when(F.col("__anchored").isNull(), F.lit("anchor neuron not found"))
            .otherwise(F.lit("ok"))
            .alias("status"),
        )
    )


def explode_fibers(fibers: DataFrame) -> DataFrame:
    """(brain_id, fiber_id, position, neuron_id) from the id lists of each fiber, whole or in segments.

    Takes what `collect_fibers` gives, or plain fibers (`id` for `fiber_id`, no `first_position`).
    """
    fiber = F.col("fiber_id") if "fiber_id" in fibers.columns else F.col("id")
    first = F.col("first_position") if "first_position" in fibers.columns else F.lit(0).cast("bigint")
    listed = fibers.select("brain_id", fiber.alias("fiber_id"), first.alias("__first"), F.posexplode("neuron_ids").alias("__at", "neuron_id"))
    return listed.select("brain_id", "fiber_id", (F.col("__first") + F.col("__at")).alias("position"), "neuron_id")


def collect_fibers(junction: DataFrame, segment: int = 10_000) -> DataFrame:
    """Back to ordered id lists (brain_id, fiber_id, segment, first_position, neuron_ids), `segment` positions a row at most.

    Nearly all fibers have one segment (0); a huge one is spread over several bounded rows. Positions may have gaps: each
    segment is cut where its positions are no longer consecutive, so exploding gives the same positions back. A position
    given twice keeps its least id.
    """
    once = junction.groupBy("brain_id", "fiber_id", F.col("position").cast("bigint").alias("position")).agg(F.min("neuron_id").alias("neuron_id"))
    listed = F.array_sort(F.collect_list(F.struct("position", "neuron_id")))
    rows = once.withColumn("segment", F.floor(F.col("position") / segment)).groupBy("brain_id", "fiber_id", "segment").agg(listed.alias("__items"))
    # position less place is constant along consecutive positions
    runs = F.array_distinct(F.transform("__items", lambda item, i: item["position"] - i))
    rows = rows.select("brain_id", "fiber_id", "segment", "__items", F.explode(runs).alias("__run"))
    items = F.filter("__items", lambda item, i: item["position"] - i == F.col("__run"))
    return rows.select(
        "brain_id",
        "fiber_id",
        "segment",
        items[0]["position"].alias("first_position"),
        F.transform(items, lambda item: item["neuron_id"]).alias("neuron_ids"),
    )
