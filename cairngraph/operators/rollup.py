"""Counts, rankings and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.functions.scalars import utc_iso
from cairngraph.operators.common import top_n


def generation_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored symbols and edges per generation and project."""
    by = ["generation_id", "project_path"]
    symbols = nodes.groupBy(*by).agg(F.count(F.lit(1)).alias("symbols"))
    links = edges.groupBy(*by).agg(F.count(F.lit(1)).alias("edges"))
    return symbols.join(links, by, "full_outer").select(
        *by,
        F.coalesce("symbols", F.lit(0)).alias("symbols"),
        F.coalesce("edges", F.lit(0)).alias("edges"),
    )


def brain_stats(neurons: DataFrame, synapses: DataFrame, fibers: DataFrame) -> DataFrame:
    """Rows of each kind per brain."""
    counted = [
        frame.groupBy("brain_id").agg(F.count(F.lit(1)).alias(name))
        for frame, name in ((neurons, "neurons"), (synapses, "synapses"), (fibers, "fibers"))
    ]
    joined = counted[0].join(counted[1], "brain_id", "full_outer")
    joined = joined.join(counted[2], "brain_id", "full_outer")
    return joined.na.fill(0, ["neurons", "synapses", "fibers"])


def index_report(scan: DataFrame, generation: DataFrame) -> DataFrame:
    """One row about an index run: outcome, generation, counts, planned languages."""
    fields = ["generation_id", "status", "symbol_count", "edge_count", "skipped_files", "error"]
    gen = generation.agg(F.max(F.struct(*fields)).alias("gen")).scalar()
    return scan.withColumn("gen", gen).select(
        F.when(F.col("outcome") != "ok", F.col("outcome"))
        .when(F.col("gen.status") == "active", F.lit("success"))
        .otherwise(F.lit("error"))
        .alias("status"),
        "gen.generation_id",
        F.col("supported_files").alias("files_scanned"),
        F.coalesce("gen.symbol_count", F.lit(0)).alias("symbols"),
        F.coalesce("gen.edge_count", F.lit(0)).alias("edges"),
        F.coalesce("gen.skipped_files", F.lit(0)).alias("skipped"),
        "planned_files",
        "planned_languages",
        "gen.error",
    )


def index_reports(scans: DataFrame, generations: DataFrame) -> DataFrame:
    """One row per project about an index run: outcome, generation, counts, planned languages.

    `generations` holds the generations of this run only.
    """
    gens = generations.select(
        F.col("project_path").alias("project"), "generation_id", F.col("status").alias("__status"),
        "symbol_count", "edge_count", "skipped_files", "error",
    )
    return scans.join(gens, "project", "left").select(
        "project",
        F.when(F.col("outcome") != "ok", F.col("outcome"))
        .when(F.col("__status") == "active", F.lit("success"))
        .otherwise(F.lit("error"))
        .alias("status"),
        "generation_id",
        F.col("supported_files").alias("files_scanned"),
        F.coalesce("symbol_count", F.lit(0)).alias("symbols"),
        F.coalesce("edge_count", F.lit(0)).alias("edges"),
        F.coalesce("skipped_files", F.lit(0)).alias("skipped"),
        "planned_files",
        "planned_languages",
        "truncated",
        "oversized_files",
        "error",
    )


def affected_files(impact_symbols: DataFrame, by: str | None = None) -> DataFrame:
    """Distinct files of an impact result as rows, per seed when `by` is given."""
    keys = [by] if by else []
    return impact_symbols.select(*keys, "file").distinct()


def repair_summary(candidates: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(count per reason, the first n candidates by last use and id with ISO times)."""
    counts = candidates.groupBy("reason").agg(F.count(F.lit(1)).alias("candidates"))
    samples = (
        candidates.orderBy("last_conducted", "id")
        .limit(n)
        .select(
            "id",
            "reason",
            utc_iso("created_at").alias("created_at"),
            utc_iso("last_conducted").alias("last_conducted"),
            utc_iso("normalized_last_conducted").alias("normalized_last_conducted"),
        )
    )
    return counts, samples


def hot_slots(df: DataFrame, n: int, score: str = "score", tie: str = "neuron_id") -> DataFrame:
    """The n best rows of each brain, numbered from 1."""
    return top_n(df, ["brain_id"], [F.desc(score), F.col(tie)], n, "slot")


def rank_gaps(gaps: DataFrame, n: int) -> DataFrame:
    """The n most urgent open gaps of each brain."""
    still_open = gaps.filter(F.col("resolved_at").isNull())
    return top_n(still_open, ["brain_id"], [F.desc("priority"), F.col("id")], n, "rank")


def cognitive_rollup(states: DataFrame) -> DataFrame:
    return states.groupBy("brain_id", "status").agg(
        F.count(F.lit(1)).alias("states"),
        F.avg("confidence").alias("mean_confidence"),
        F.sum("evidence_for_count").alias("evidence_for"),
        F.sum("evidence_against_count").alias("evidence_against"),
    )

