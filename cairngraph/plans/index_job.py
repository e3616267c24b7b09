"""Index runs over the files of any number of projects.

Each project goes its own way through the states building, active, failed and gc: what its facts hold is counted per
project, what the tables hold is counted per generation, and only where both agree a generation becomes active. A project that
cannot be read, or whose rows got lost, fails alone and keeps its former generation.
"""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Callable, Iterable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.functions import scalars as S
from cairngraph.operators import facts as facts_ops
from cairngraph.operators import lifecycle, resolve
from cairngraph.operators.common import grown
from cairngraph.operators.rollup import index_reports
from cairngraph.operators.tables import upsert
from cairngraph.session import compact, cut, freed_shuffles, scratch
from cairngraph.sources.files import scan_files, scan_projects, scan_report

Tables = dict[str, DataFrame]
FACT_TABLES = ("defs", "imports", "bases", "calls")


class IndexRunFailed(RuntimeError):
    """An index run stopped; `tables` has its generations marked as failed."""

    def __init__(self, message: str, tables: Tables):
        super().__init__(message)
        self.tables = tables


def generation_key(project: str, now: str) -> str:
    """The id of a project's generation, for use as a literal."""
    path = posixpath.normpath(project if project.startswith("/") else f"/{project}")
    return hashlib.sha256(f"{path}:{now}".encode()).hexdigest()[:16]


def index_projects(
    spark: SparkSession,
    files: DataFrame,
    tables: Tables | None = None,
    exts: Iterable[str] | None = None,
    max_files: int | None = None,
    force: bool = False,
    now: str | None = None,
    facts: Tables | None = None,
    write: Callable[[str, DataFrame], DataFrame] | None = None,
) -> tuple[Tables, DataFrame]:
    """(tables with the new generations, one report row per project) of `files`, whose `project` may be written in any way.

    Python files are read here; `facts` brings fact tables of the JS/TS files. A file that cannot be
    read is skipped with all its rows. When none of a project can be read its generation fails and the former one
    stays active. Equal definitions are stored once; the report counts the others as duplicates. `write` stores the new rows of
    a table (its name, the rows) and reads them back. Any other error marks the run's generations as failed and is raised
    as `IndexRunFailed`. Files without a project are left out.
    """
    tables = dict(tables or lifecycle.empty_store(spark))
    now = now or datetime.now(UTC).isoformat()
    files = files.filter("project is not null").withColumn("project", S.normalize_path("project"))
    scans = cut(scan_projects(files, exts, max_files)[0])
    if force:
        tables["nodes"], tables["edges"], tables["generations"], _ = lifecycle.clear_indexes(
            tables["nodes"], tables["edges"], tables["generations"], scans
        )
    wanted = scans.filter("outcome = 'ok'")
    gens = cut(lifecycle.create_generations(tables["generations"], wanted, now))
    try:
        with freed_shuffles(spark):
            stored, outcomes = _run(tables, files, wanted, now, exts, max_files, facts, write or (lambda name, rows: compact(rows)))
            gens = cut(lifecycle.settle(gens, stored["nodes"], stored["edges"], outcomes))
    except Exception as error:
        tables["generations"] = cut(lifecycle.fail_building(gens, now, str(error)[:1000]))
        raise IndexRunFailed(f"the run at {now} stopped: {error}", tables) from error
    stored["generations"] = gens
    ours = gens.filter(F.col("created_at") == now)
    doubles = outcomes.select(F.col("project_path").alias("project"), "duplicate_symbols")
    report = index_reports(scans, ours).join(doubles, "project", "left")
    return stored, report.withColumn("duplicate_symbols", F.coalesce("duplicate_symbols", F.lit(0).cast("bigint")))


def index_project(spark: SparkSession, files: DataFrame, *args, **more) -> tuple[Tables, DataFrame]:
    """`index_projects` for the files of one project; of no files at all there is a report, too."""
    tables, report = index_projects(spark, files, *args, **more)
    asked = cut(report)
    if asked.isEmpty():
        none = scan_report(files)[0].withColumn("project", F.lit(None).cast("string"))
        asked = index_reports(none, tables["generations"].limit(0)).withColumn("duplicate_symbols", F.lit(0).cast("bigint"))
    return tables, asked


def spark_parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _written(name: str, write, rows: DataFrame) -> DataFrame:
    """What `write` made of the rows; stored where it still reads what goes with the run."""
    found = write(name, rows)
    return compact(found) if any("/scratch-" in file for file in found.inputFiles()) else found


def _run(tables, files, wanted, now, exts, max_files, extra, write) -> tuple[Tables, DataFrame]:
    """(tables with the new rows, what the facts of each project hold)."""
    files = files.join(wanted.select("project"), "project", "left_semi").select(*files.columns)
    scanned = scan_files(files, exts, max_files).select("project", "path", "length", "content")
    n = F.count(F.lit(1))
    with scratch(files.sparkSession) as keep:
        defs, imports, bases, calls, errors = facts_ops.split_facts(keep(facts_ops.facts_table(scanned, spark_parallelism(files))))
        healthy = facts_ops.healthy_files(scanned, errors).select("project", "path")
        resolved = resolve.resolve_python_modules(imports, files)
        if extra:
            defs = defs.unionByName(extra["defs"])
            bases = bases.unionByName(extra["bases"])
            calls = calls.unionByName(extra["calls"])
            resolved = resolved.unionByName(resolve.resolve_js_modules(extra["imports"], files))
        symbols = keep(resolve.all_symbols(healthy, defs))
        edges = keep(resolve.all_edges(symbols, keep(resolved), bases, calls, keep))
        skipped = errors.select("project", "file").distinct().groupBy("project").agg(n.alias("skipped"))
        generation = S.generation_id(F.col("project"), F.lit(now))
        fresh_nodes = _written("nodes", write, lifecycle.symbol_nodes(symbols, generation).dropDuplicates(["id"]))
        # both ends are looked up before an edge has its long ids; edges are unique by now, so the ids are too
        whole = edges.select("project", "source_sid", "target_sid", "type", "line")
        for end in ("source_sid", "target_sid"):
            whole = whole.join(grown(fresh_nodes.select("id")), S.node_id(generation, F.col(end)) == F.col("id"), "left_semi")
        fresh_edges = _written("edges", write, lifecycle.symbol_edges(whole, generation))
        stored = dict(tables)
        # an id is written once, whatever order would choose
        stored["nodes"] = upsert(tables["nodes"], fresh_nodes, ["id"], ["id"])
        stored["edges"] = tables["edges"].join(grown(fresh_edges.select("id")), "id", "left_anti").unionByName(fresh_edges)
        by_symbol = symbols.groupBy("project").agg(F.count_distinct("symbol_id").alias("symbols"), n.alias("__all"))
        # counted on the facts, whatever becomes of the tables
        ids = grown(symbols.select("symbol_id").distinct())
        whole = edges.join(ids.withColumnRenamed("symbol_id", "source_sid"), "source_sid", "left_semi")
        whole = whole.join(ids.withColumnRenamed("symbol_id", "target_sid"), "target_sid", "left_semi")
        by_edge = whole.groupBy("project").agg(n.alias("edges"))
        zero = F.lit(0).cast("bigint")
        unreadable = F.when(
            F.col("skipped") == F.col("supported_files"), F.concat(F.lit("none of the files could be read in "), F.col("project"))
        )
        outcomes = (
            wanted.join(skipped, "project", "left").join(by_symbol, "project", "left").join(by_edge, "project", "left")
            .select(
                generation.alias("generation_id"),
                F.col("project").alias("project_path"),
                F.coalesce("symbols", zero).alias("symbols"),
                F.coalesce("edges", zero).alias("edges"),
                F.coalesce("skipped", zero).alias("skipped"),
                unreadable.alias("error"),
                (F.coalesce("__all", zero) - F.coalesce("symbols", zero)).alias("duplicate_symbols"),
            )
        )
        return stored, cut(outcomes)
