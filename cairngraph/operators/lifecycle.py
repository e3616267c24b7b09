"""Index generations, cascading deletes, repair, decay and pruning.

Every change takes tables in and gives new tables back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairngraph.functions import scalars as S
from cairngraph.operators.common import union_all
from cairngraph.operators.graph import valid_edges
from cairngraph.operators.rollup import generation_counts
from cairngraph.operators.search import CODE_TAG
from cairngraph.operators.tables import insert_ignore, upsert
from cairngraph.schemas import CODE_EDGES, CODE_NODES, FOREIGN_KEYS, GENERATIONS, PRIMARY_KEYS


class CountMismatch(ValueError):
    """The stored rows of a generation are not as many as were reported."""


# --- generations ----------------------------------------------------------------------------


def create_generation(gens: DataFrame, path: str, now: str) -> DataFrame:
    """`gens` plus a row in status building; its id follows from path and time."""
    project = S.normalize_path(F.lit(path))
    row = gens.sparkSession.range(1).select(
        S.generation_id(project, F.lit(now)).alias("generation_id"),
        project.alias("project_path"),
        F.lit("building").alias("status"),
        F.lit(now).alias("created_at"),
        F.lit(0).cast("bigint").alias("symbol_count"),
        F.lit(0).cast("bigint").alias("edge_count"),
        F.lit(0).cast("bigint").alias("skipped_files"),
        F.lit(None).cast("string").alias("error"),
    )
    return gens.unionByName(row, allowMissingColumns=True)


def create_generations(gens: DataFrame, projects: DataFrame, now: str) -> DataFrame:
    """`gens` plus a row in status building for each of `projects` (project, normalized)."""
    rows = projects.select("project").distinct().select(
        S.generation_id(F.col("project"), F.lit(now)).alias("generation_id"),
        F.col("project").alias("project_path"),
        F.lit("building").alias("status"),
        F.lit(now).alias("created_at"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("symbol_count", "edge_count", "skipped_files")],
        F.lit(None).cast("string").alias("error"),
    )
    return gens.unionByName(rows, allowMissingColumns=True)


def settle(gens: DataFrame, nodes: DataFrame, edges: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The building generations become active or failed, each by its own counts.

    `outcomes` has a row per generation (generation_id, project_path, symbols, edges, skipped, error): what its facts hold. A
    generation fails with the error given, or when the tables hold other numbers of its rows; the project's former
    active generation then stays. Where it becomes active, that one becomes gc.
    """
    held = generation_counts(nodes, edges).select(
        "generation_id", F.col("symbols").alias("__symbols"), F.col("edges").alias("__edges")
    )
    judged = outcomes.join(held, "generation_id", "left")
    wrong = []
    for label, column in (("symbol", "symbols"), ("edge", "edges")):
        stored = F.coalesce(f"__{column}", F.lit(0))
        text = F.format_string(f"{label} rows stored for %s: %d, expected %d", "generation_id", stored, F.col(column))
        wrong.append(F.when(stored != F.col(column), text))
    judged = judged.select(
        "generation_id",
        F.coalesce("error", *wrong).alias("__error"),
        F.coalesce("__symbols", F.lit(0)).alias("__symbols"),
        F.coalesce("__edges", F.lit(0)).alias("__edges"),
        F.col("skipped").alias("__skipped"),
        F.lit(True).alias("__ours"),
    )
    swapped = outcomes.select("generation_id", "project_path").join(judged.filter("__error is null").select("generation_id"), "generation_id")
    swapped = swapped.select("project_path").distinct().withColumn("__swapped", F.lit(True))
    joined = gens.join(judged, "generation_id", "left").join(swapped, "project_path", "left")
    ours, good = F.coalesce("__ours", F.lit(False)), F.col("__error").isNull()
    status = (
        F.when(ours & good, F.lit("active"))
        .when(ours, F.lit("failed"))
        .when(F.coalesce("__swapped", F.lit(False)) & (F.col("status") == "active"), F.lit("gc"))
        .otherwise(F.col("status"))
    )
    changed = {
        "status": status,
        "symbol_count": F.when(ours & good, F.col("__symbols")).otherwise(F.col("symbol_count")),
        "edge_count": F.when(ours & good, F.col("__edges")).otherwise(F.col("edge_count")),
        "skipped_files": F.when(ours, F.col("__skipped")).otherwise(F.col("skipped_files")),
        "error": F.when(ours, F.col("__error")).otherwise(F.col("error")),
    }
    return joined.withColumns(changed).select(*gens.columns)


def fail_building(gens: DataFrame, now: str, error: str) -> DataFrame:
    """All generations that a run at `now` left building fail with its error; active ones stay."""
    ours = (F.col("status") == "building") & (F.col("created_at") == now)
    return gens.withColumns(
        {"status": F.when(ours, F.lit("failed")).otherwise(F.col("status")), "error": F.when(ours, F.lit(error)).otherwise(F.col("error"))}
    )


def empty_store(spark) -> dict[str, DataFrame]:
    return {
        "nodes": spark.createDataFrame([], CODE_NODES),
        "edges": spark.createDataFrame([], CODE_EDGES),
        "generations": spark.createDataFrame([], GENERATIONS),
    }


def symbol_nodes(symbols: DataFrame, generation: str | Column) -> DataFrame:
    """Symbols as stored nodes of a generation."""
    gen = F.lit(generation) if isinstance(generation, str) else generation
    return symbols.select(
        S.node_id(gen, "symbol_id").alias("id"),
        "symbol_id",
        "name",
        "qualified_name",
        "kind",
        "file",
        "line",
        "language",
        "signature",
        S.content_text("kind", "qualified_name", "file", "line").alias("content"),
        F.array(F.lit(CODE_TAG), "kind", "language").alias("tags"),
        F.col("project").alias("project_path"),
        gen.alias("generation_id"),
    )


def symbol_edges(edges: DataFrame, generation: str | Column) -> DataFrame:
    """Resolved relations as stored edges of a generation."""
    gen = F.lit(generation) if isinstance(generation, str) else generation
    return edges.select(
        S.edge_id(gen, "source_sid", "type", "target_sid").alias("id"),
        S.node_id(gen, "source_sid").alias("src"),
        S.node_id(gen, "target_sid").alias("dst"),
        F.col("type").alias("edge_type"),
        "line",
        F.lit(1.0).alias("weight"),
        F.col("project").alias("project_path"),
        gen.alias("generation_id"),
    )


def store_symbols(nodes: DataFrame, symbols: DataFrame, generation: str | Column) -> DataFrame:
    """`nodes` with the symbols added; storing a symbol again replaces it."""
    return upsert(nodes, symbol_nodes(symbols, generation), ["id"])


def store_edges(
    store: DataFrame, edges: DataFrame, nodes: DataFrame, generation: str | Column
) -> DataFrame:
    """`store` with the edges added whose two ends are stored; known edge ids stay as they are."""
    fresh = valid_edges(symbol_edges(edges, generation), nodes)
    return insert_ignore(store, fresh, ["id"], ["line"])


def activate(
    gens: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    generation: str,
    project: str,
    symbol_count: int | None = None,
    edge_count: int | None = None,
    skipped_files: int | None = None,
) -> DataFrame:
    """The generation becomes active and the project's active ones become gc.

    Fails when an expected count differs from what is stored.
    """
    ours = (F.col("generation_id") == generation) & (F.col("project_path") == project)
    counted = generation_counts(nodes.filter(ours), edges.filter(ours)).head(1)
    symbols, links = (counted[0]["symbols"], counted[0]["edges"]) if counted else (0, 0)
    for label, actual, expected in (
        ("symbol", symbols, symbol_count),
        ("edge", links, edge_count),
    ):
        if expected is not None and actual != expected:
            raise CountMismatch(f"{label} rows stored for {generation}: {actual}, expected {expected}")
    swapped = F.when(ours, F.lit("active")).when(
        (F.col("project_path") == project) & (F.col("status") == "active"), F.lit("gc")
    )
    changed = {
        "status": swapped.otherwise(F.col("status")),
        "symbol_count": F.when(ours, F.lit(symbols)).otherwise(F.col("symbol_count")),
        "edge_count": F.when(ours, F.lit(links)).otherwise(F.col("edge_count")),
    }
    if skipped_files is not None:
        changed["skipped_files"] = F.when(ours, F.lit(skipped_files)).otherwise(
            F.col("skipped_files")
        )
    return gens.withColumns(changed)


def fail(gens: DataFrame, generation: str, error: str) -> DataFrame:
    """The generation failed with an error; the active one stays active."""
    ours = F.col("generation_id") == generation
    return gens.withColumns(
        {
            "status": F.when(ours, F.lit("failed")).otherwise(F.col("status")),
            "error": F.when(ours, F.lit(error)).otherwise(F.col("error")),
        }
    )


def clear_index(
    nodes: DataFrame, edges: DataFrame, gens: DataFrame, project: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, generations, one-row count of removed nodes) without the project's index.

    Edges go with their end nodes, whichever project they name.
    """
    one = nodes.sparkSession.range(1).select(S.normalize_path(F.lit(project)).alias("project"))
    return clear_indexes(nodes, edges, gens, one)


def clear_indexes(
    nodes: DataFrame, edges: DataFrame, gens: DataFrame, projects: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The same for a table of projects (project, normalized)."""
    paths = projects.select(F.col("project").alias("project_path")).distinct().withColumn("__gone", F.lit(True))
    marked = nodes.join(paths, "project_path", "left")
    tagged = S.has_tag("tags", CODE_TAG) if "tags" in nodes.columns else F.lit(True)
    doomed = F.coalesce(F.col("__gone") & tagged, F.lit(False))
    gone = marked.filter(doomed).select("id")
    left = edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti")
    left = left.join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
    old = gens.join(paths, "project_path", "left_semi")
    removed = union_all([gone, old.select("generation_id").toDF("id")]).agg(F.count(F.lit(1)).alias("removed"))
    return (
        marked.filter(~doomed).select(*nodes.columns),
        left.select(*edges.columns),
        gens.join(paths, "project_path", "left_anti").select(*gens.columns),
        removed,
    )


# --- cascading delete -----------------------------------------------------------------------


def cascade_delete(
    tables: dict[str, DataFrame],
    root_table: str,
    keys: DataFrame,
    foreign_keys: Sequence[tuple[str, str, dict[str, str]]] = FOREIGN_KEYS,
    primary_keys: dict[str, Sequence[str]] = PRIMARY_KEYS,
) -> dict[str, DataFrame]:
    """Tables without the root rows of `keys` and without everything that refers to removed rows."""
    root_key = list(primary_keys[root_table])
    removed = {root_table: keys.select(*root_key).distinct()}
    result = dict(tables)
    for name in _parents_first(tables, foreign_keys):
        if name not in removed:
            doomed = [
                tables[name]
                .join(
                    removed[parent].select(
                        *[F.col(there).alias(here) for here, there in columns.items()]
                    ),
                    list(columns),
                    "left_semi",
                )
                .select(*primary_keys[name])
                for child, parent, columns in foreign_keys
                if child == name and parent in removed
            ]
            if not doomed:
                continue
            removed[name] = union_all(doomed).distinct()
        kept = tables[name].join(removed[name], list(primary_keys[name]), "left_anti")
        result[name] = kept.select(*tables[name].columns)
    return result


def _parents_first(tables, foreign_keys) -> list[str]:
    order: list[str] = []
    waiting = list(tables)
    while waiting:
        ready = [
            t
            for t in waiting
            if all(p not in waiting or p == t for c, p, _ in foreign_keys if c == t)
        ]
        order += ready
        waiting = [t for t in waiting if t not in ready]
    return order


# --- repair, decay, pruning -----------------------------------------------------------------


def repair_candidates(fibers: DataFrame, policy: str = "all", floor: int = S.YEAR_FLOOR) -> DataFrame:
    return fibers.withColumns(
        {
            "reason": S.repair_reason("created_at", "last_conducted", policy, floor),
            "normalized_last_conducted": S.normalize_last("created_at", "last_conducted", floor),
        }
    ).filter(F.col("reason").isNotNull())


def repair(
    fibers: DataFrame, policy: str = "all", floor: int = S.YEAR_FLOOR, apply: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(fibers, candidates). Only with `apply` the fibers differ; both are plain projections."""
    candidates = repair_candidates(fibers, policy, floor)
    if not apply:
        return fibers, candidates
    reason = S.repair_reason("created_at", "last_conducted", policy, floor)
    fixed = F.when(
        reason.isNotNull(), S.normalize_last("created_at", "last_conducted", floor)
    ).otherwise(F.col("last_conducted"))
    return fibers.withColumn("last_conducted", fixed), candidates


def decay(states: DataFrame, at: Column) -> DataFrame:
    """Activation faded by its rate since it was last activated; never activated stays."""
    hours = S.age_hours("last_activated", at)
    faded = F.col("activation_level") * F.exp(-F.col("decay_rate") * hours)
    return states.withColumn("activation_level", F.coalesce(faded, F.col("activation_level")))


def prune(
    edges: DataFrame, min_weight: float, idle_hours: float, keep_reinforced: int, at: Column
) -> DataFrame:
    """Without edges that are weak, long unused and seldom reinforced. Never used counts as idle."""
    idle = F.coalesce(S.age_hours("last_activated", at) > idle_hours, F.lit(True))
    weak = (F.col("weight") < min_weight) & idle & (F.col("reinforced_count") < keep_reinforced)
    return edges.filter(~F.coalesce(weak, F.lit(False)))
