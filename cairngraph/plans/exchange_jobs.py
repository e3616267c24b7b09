"""Whole runs around the store: migrate tables, repair timestamps, synchronise two stores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.functions.scalars import YEAR_FLOOR
from cairngraph.operators import lifecycle
from cairngraph.operators.common import first_by, union_all
from cairngraph.operators.rollup import repair_summary
from cairngraph.operators.tables import merge_snapshots, sortable, upsert
from cairngraph.schemas import LOAD_ORDER, NOT_NULL, PRIMARY_KEYS
from cairngraph.sources import exchange, snapshots

Tables = dict[str, DataFrame]

# The column that says which of two versions of a row is stronger.
STRENGTH = {"neurons": "activation_level", "synapses": "weight", "fibers": "salience"}


def migrate(
    source: Tables,
    catalog: dict[str, dict[str, str]],
    order: Sequence[str] = LOAD_ORDER,
) -> tuple[Tables, DataFrame, DataFrame]:
    """(loaded tables, report, quarantined rows of all tables) from loosely typed tables.

    Columns are reconciled with the catalog, values coerced, rows without a required value left
    out, keys made unique. The report has rows ok and err and the verification status per table.
    """
    kept, _ = exchange.reconcile_tables({n: source[n] for n in order if n in source}, catalog)
    loaded, reports, errors = {}, [], []
    for name, frame in kept.items():
        key = list(PRIMARY_KEYS[name])
        required = [c for c in NOT_NULL[name] if c in frame.columns]
        good, bad, counts = exchange.load_with_quarantine(
            frame, catalog[name], required, key
        )
        loaded[name] = first_by(good, key, sortable(good, key))
        reports.append(counts.select(F.lit(name).alias("table_name"), "ok", "err"))
        keys = F.concat_ws(":", *[F.col(k).cast("string") for k in key])
        errors.append(bad.select(F.lit(name).alias("table_name"), keys.alias("key"), "error", "raw"))
    status = exchange.verify_counts({n: kept[n] for n in kept}, loaded)
    return loaded, union_all(reports).join(status, "table_name"), union_all(errors)


def run_repair(
    fibers: DataFrame,
    brain_id: str,
    policy: str = "all",
    floor: int = YEAR_FLOOR,
    apply: bool = False,
    backup_dir: str | None = None,
    now: datetime | None = None,
    sample_limit: int = 10,
) -> tuple[DataFrame, dict, DataFrame]:
    """(fibers, summary, samples) of repairing one brain. A dry run changes and writes nothing.

    Before a change the affected rows are backed up. Rows of other brains stay, also those with
    the same id.
    """
    ours = F.col("brain_id") == brain_id
    candidates = lifecycle.repair_candidates(
        exchange.scan_fibers(fibers, brain_id), policy, floor
    )
    counts, samples = repair_summary(candidates, sample_limit)
    total = counts.agg(F.coalesce(F.sum("candidates"), F.lit(0)).alias("n")).head()["n"]
    summary = {
        "brain_id": brain_id, "policy": policy, "apply": apply, "candidate_count": total,
        "updated_count": 0, "backup_path": None,
    }
    if not apply or total == 0:
        return fibers, summary, samples
    if backup_dir is not None:
        stamp = now or datetime.now(UTC)
        summary["backup_path"] = exchange.write_backup(candidates, backup_dir, stamp)
    summary["updated_count"] = total
    fixed, _ = lifecycle.repair(fibers.filter(ours), policy, floor, apply=True)
    others = fibers.filter(~F.coalesce(ours, F.lit(False)))
    return fixed.unionByName(others), summary, samples


def sync_stores(
    local: Tables, remote: Tables | None, brain_id: str, strategy: str = "prefer_local"
) -> tuple[Tables, DataFrame | None]:
    """(the brain's merged tables for both stores, report per table).

    Without a remote the local tables are what is pushed, and there is no report.
    """
    mine = snapshots.export_brain(local, brain_id)
    if remote is None:
        return mine, None
    theirs = snapshots.export_brain(remote, brain_id)
    merged, reports = {}, []
    for name, frame in mine.items():
        if name not in theirs:
            merged[name] = frame
            continue
        merged[name], report = merge_snapshots(
            frame, theirs[name], strategy, PRIMARY_KEYS[name], strength=STRENGTH.get(name, "weight")
        )
        reports.append(report.withColumn("table_name", F.lit(name)))
    return merged, union_all(reports)


def sync(
    local: Tables, remote: Tables | None, brain_id: str, strategy: str = "prefer_local"
) -> tuple[Tables, Tables, DataFrame]:
    """(local tables, remote tables, report) after both stores hold the same rows of the brain.

    The brain is exported from both sides and merged; locally it is cleared and imported again, remotely the merged
    rows replace those of the same key. Without a remote that can be read the local rows are pushed as they are. The report
    has a row per table: what was added, updated, skipped and in conflict, and whether it was pulled and pushed.
    """
    merged, report = sync_stores(local, remote, brain_id, strategy)
    kept = snapshots.import_brain(snapshots.clear_brain(local, brain_id), merged)
    pushed = dict(remote or {})
    for name, frame in merged.items():
        pushed[name] = upsert(pushed[name], frame, PRIMARY_KEYS[name]) if name in pushed else frame
    if report is None:
        spark = next(iter(local.values())).sparkSession
        report = spark.createDataFrame([(name,) for name in merged], "table_name string")
        report = report.select("table_name", *[F.lit(0).cast("bigint").alias(c) for c in ("added", "updated", "skipped", "conflicts")])
    report = report.select("table_name", "added", "updated", "skipped", "conflicts")
    return kept, pushed, report.withColumns({"pulled": F.lit(remote is not None), "pushed": F.lit(True)})
