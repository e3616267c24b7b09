"""Change feed: add, update and delete records applied in order, latest per key.

The target is a base and deltas, tied together by a manifest:

    deltas/epoch=<query id>/batch=<number>   one row per key that the micro-batch brought
    base/version=<n>                         the log up to a fold, one row per key
    manifest/version=<n>                     of each epoch the last batch that the base holds

A batch only writes what it brought, and writing a batch again replaces its own folder, so a retry changes nothing. An epoch is one
checkpoint's life: a stream that starts over with a new checkpoint counts its batches from 0 again, but under a new epoch.
`compact` writes a new base beside the old one; the manifest that names it appears whole or not at all, and readers take the
latest, so they see the old base with its deltas or the new one with the rest.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DELETE = "delete"
MANIFEST = "version bigint, epoch string, last_batch bigint"


def latest_changes(changes: DataFrame, key: str = "key", seq: str = "seq") -> DataFrame:
    """One row per key: its last change, and the last delete among its changes."""
    columns = [c for c in changes.columns if c != key]
    deleted = F.when(F.col("op") == DELETE, F.col(seq))
    if "deleted_seq" in columns:
        columns.remove("deleted_seq")
        deleted = F.greatest(deleted, F.col("deleted_seq"))
    return (
        changes.groupBy(key)
        .agg(
            F.max_by(F.struct(*columns), seq).alias("last"),
            F.max(deleted).alias("deleted_seq"),
        )
        .select(key, "last.*", "deleted_seq")
    )


def apply_changes(
    stream: DataFrame, target_dir: str, checkpoint_dir: str, key: str = "key", seq: str = "seq"
) -> StreamingQuery:
    """Read all available changes of the stream into deltas below `target_dir`."""
    fallback = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the id is kept in the checkpoint, so it outlives restarts and ends with it
        epoch = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or fallback
        latest_changes(batch, key, seq).write.mode("overwrite").parquet(
            f"{target_dir}/deltas/epoch={epoch}/batch={batch_id:012d}"
        )

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def manifest(spark: SparkSession, target_dir: str) -> DataFrame:
    """(version, epoch, last_batch) of the latest fold; no row before the first. One row per epoch."""
    rows = _read(spark, f"{target_dir}/manifest")
    if rows is None:
        return spark.createDataFrame([], MANIFEST)
    newest = rows.agg(F.max("version")).head()[0]
    return rows.filter(F.col("version") == newest).select(
        F.col("version").cast("bigint").alias("version"), "epoch", "last_batch"
    )


def _deltas(spark: SparkSession, target_dir: str) -> DataFrame | None:
    rows = _read(spark, f"{target_dir}/deltas")
    return rows if rows is None else rows.withColumns({"epoch": F.col("epoch").cast("string"), "batch": F.col("batch").cast("bigint")})


def _log(spark: SparkSession, target_dir: str, folded: list, upto: dict[str, int] | None, key: str, seq: str) -> DataFrame | None:
    """The base of a manifest's rows and the deltas after it, of each epoch up to a batch."""
    deltas = _deltas(spark, target_dir)
    parts = []
    if folded:
        parts.append(spark.read.parquet(f"{target_dir}/base/version={folded[0]['version']}"))
    if deltas is not None:
        fresh = F.lit(True)
        for row in folded:
            fresh = fresh & ((F.col("epoch") != row["epoch"]) | (F.col("batch") > row["last_batch"]))
        for epoch, batch in (upto or {}).items():
            fresh = fresh & ((F.col("epoch") != epoch) | (F.col("batch") <= batch))
        if upto is not None:
            fresh = fresh & F.col("epoch").isin(list(upto))
        # both are columns of the folders: folded ones are not read
        parts.append(deltas.filter(fresh).drop("epoch", "batch"))
    if not parts:
        return None
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return latest_changes(whole, key, seq)


def current_log(spark: SparkSession, target_dir: str, key: str = "key", seq: str = "seq") -> DataFrame:
    """Last change per key over base and deltas, deleted keys included."""
    log = _log(spark, target_dir, manifest(spark, target_dir).collect(), None, key, seq)
    if log is None:
        raise FileNotFoundError(f"no change has been written to {target_dir}")
    return log


def current_rows(log: DataFrame) -> DataFrame:
    """The table as the changes leave it."""
    return log.filter(F.col("op") != DELETE).drop("op", "deleted_seq")


def live_edges(edges: DataFrame, log: DataFrame, key: str = "key", seq: str = "seq") -> DataFrame:
    """Edges (src, dst, seq) whose ends exist and were not deleted after the edge was written.

    A node that comes back after a delete does not bring its old edges back.
    """
    nodes = log.filter(F.col("op") != DELETE).select(F.col(key), "deleted_seq")
    kept = edges
    for end in ("src", "dst"):
        ends = nodes.select(F.col(key).alias(end), F.col("deleted_seq").alias("__deleted"))
        kept = kept.join(ends, end).filter(
            F.col("__deleted").isNull() | (F.col("__deleted") < F.col(seq))
        )
        kept = kept.drop("__deleted")
    return kept.select(*edges.columns)


def compact(spark: SparkSession, target_dir: str, key: str = "key", seq: str = "seq") -> int:
    """Fold the deltas there are into a new base and return its version; a stream may go on meanwhile and after.

    Batches that arrive during the fold stay deltas. Two folds at once make the same version, and the second fails.
    """
    folded = manifest(spark, target_dir).collect()
    deltas = _deltas(spark, target_dir)
    if deltas is None:
        raise FileNotFoundError(f"no change has been written to {target_dir}")
    # one row per epoch, from the folders' names
    upto = {r["epoch"]: r["last"] for r in deltas.groupBy("epoch").agg(F.max("batch").alias("last")).collect()}
    version = folded[0]["version"] + 1 if folded else 1
    _log(spark, target_dir, folded, upto, key, seq).write.parquet(f"{target_dir}/base/version={version}")
    rows = [(epoch, batch) for epoch, batch in upto.items()]
    rows += [(r["epoch"], r["last_batch"]) for r in folded if r["epoch"] not in upto]
    named = spark.createDataFrame(rows, "epoch string, last_batch bigint").coalesce(1)
    named.write.parquet(f"{target_dir}/manifest/version={version}")
    return version
