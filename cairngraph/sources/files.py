"""Source-tree scans over a table of files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.functions.scalars import extension_of, language_of, support_of
from cairngraph.operators.common import top_n

# Skipped directories.
IGNORED_DIRS = (".git", "node_modules", "__pycache__", "vendor", ".tmp-nmem")


def read_tree(spark: SparkSession, root: str, project: str | None = None) -> DataFrame:
    """Files below `root` as rows (project, path, length, content), path relative to the root.

    The content stays binary until someone reads it, and the size filter of `scan_files` runs
    on the length column, so files that are dropped are not decoded.
    """
    base = root.rstrip("/")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    # The reader reports a full URI: a scheme and a host that the root may lack, then the root. The path below may hold the
    # root's text again, so the first place after scheme and host counts.
    head = F.length(F.regexp_extract("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", 0)) if base.startswith("/") else F.lit(0)
    start = head + F.lit(len(base) + 2) if base.startswith("/") else F.instr(F.col("path"), base) + F.lit(len(base) + 1)
    return raw.select(
        F.lit(project or base).alias("project"),
        F.substr(F.col("path"), start).alias("path"),
        "length",
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
    )


def eligible_files(
    files: DataFrame, exts: Iterable[str] | None = None, max_size: int | None = None
) -> DataFrame:
    """Rows outside ignored directories, of a wanted extension and, if a size is given, small enough; classified."""
    ignored = "|".join(d.replace(".", r"\.") for d in IGNORED_DIRS)
    ext = extension_of("path")
    kept = files.filter(~F.col("path").rlike(f"(^|/)({ignored})/"))
    if max_size is not None:
        kept = kept.filter(F.col("length") <= max_size)
    if exts:
        kept = kept.filter(ext.isin(*{e.lower() for e in exts}))
    return kept.withColumns(
        {"ext": ext, "support": support_of(ext), "language": language_of(ext)}
    )


def _keys(files: DataFrame) -> list[str]:
    return ["project", "path"] if "project" in files.columns else ["path"]


def scan_files(
    files: DataFrame,
    exts: Iterable[str] | None = None,
    max_files: int | None = None,
    max_size: int | None = None,
) -> DataFrame:
    """The supported files; with `max_files` the first ones of each project by path.

    That choice is made on paths alone, contents only join in afterwards.
    """
    supported = eligible_files(files, exts, max_size).filter(F.col("support") == "supported")
    if max_files is None:
        return supported
    keys = _keys(files)
    paths = supported.select(*keys)
    first = paths.orderBy("path").limit(max_files) if len(keys) == 1 else top_n(paths, ["project"], ["path"], max_files)
    return supported.join(first, keys, "left_semi").select(*supported.columns)


def scan_projects(
    files: DataFrame,
    exts: Iterable[str] | None = None,
    max_files: int | None = None,
    max_size: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(one report row per project, planned files as rows with their project). `files` has a `project`.

    A report holds the outcome, the numbers of supported and planned files, the planned languages, and what a caller's limits
    left out: `truncated` and `oversized_files`. Planned files count only up to the path at which the file cap is reached. They
    stay rows, because their number has no bound.
    """
    listed = eligible_files(files.select("project", "path", "length"), exts)
    oversized = F.lit(False) if max_size is None else F.coalesce(F.col("length") > max_size, F.lit(False))
    listed = listed.withColumn("__over", oversized)
    fits = listed.filter(~F.col("__over"))
    supported = fits.filter(F.col("support") == "supported").select("project", "path")
    planned = fits.filter(F.col("support") == "planned_v2").select("project", "path", "language")
    if max_files is not None:
        first = top_n(supported, ["project"], ["path"], max_files + 1, "__rank")
        stop = first.groupBy("project").agg(
            F.max(F.when(F.col("__rank") == max_files, F.col("path"))).alias("__stop"),
            F.max((F.col("__rank") > max_files).cast("int")).alias("__more"),
        )
        planned = planned.join(stop, "project", "left").filter(F.col("__stop").isNull() | (F.col("path") < F.col("__stop"))).drop("__stop", "__more")
    n = F.count(F.lit(1))
    report = files.select("project").distinct().join(
        listed.groupBy("project").agg(
            F.count_if((F.col("support") == "supported") & ~F.col("__over")).alias("__supported"),
            F.count_if(F.col("__over") & F.col("support").isin("supported", "planned_v2")).alias("__oversized"),
        ),
        "project",
        "left",
    ).join(
        planned.groupBy("project").agg(n.alias("__planned"), F.array_sort(F.collect_set("language")).alias("__languages")), "project", "left"
    )
    found, zero = F.coalesce("__supported", F.lit(0)), F.lit(0)
    taken = found if max_files is None else F.least(found, F.lit(max_files))
    report = report.select(
        "project",
        F.when(found > 0, F.lit("ok")).when(F.coalesce("__planned", zero) > 0, F.lit("unsupported")).otherwise(F.lit("error")).alias("outcome"),
        taken.cast("bigint").alias("supported_files"),
        F.coalesce("__planned", zero).cast("bigint").alias("planned_files"),
        F.coalesce("__languages", F.array().cast("array<string>")).alias("planned_languages"),
        (found > taken).alias("truncated"),
        F.coalesce("__oversized", zero).cast("bigint").alias("oversized_files"),
    )
    return report, planned.select("project", "path", "language")


def scan_report(
    files: DataFrame,
    exts: Iterable[str] | None = None,
    max_files: int | None = None,
    max_size: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(one-row report, planned files as rows) of a table of files taken as one project; see `scan_projects`."""
    one = files.select(F.lit("").alias("project"), "path", "length")
    report, planned = scan_projects(one, exts, max_files, max_size)
    asked = files.sparkSession.range(1).select(F.lit("").alias("project"))  # a report also of no files
    columns = [c for c in report.columns if c != "project"]
    empty = {"outcome": F.lit("error"), "truncated": F.lit(False), "planned_languages": F.array().cast("array<string>")}
    filled = [F.coalesce(F.col(c), empty.get(c, F.lit(0).cast("bigint"))).alias(c) for c in columns]
    return asked.join(report, "project", "left").select(*filled), planned.select("path", "language")
