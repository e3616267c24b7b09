"""Session settings and lineage cuts."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when their frames go.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "cairngraph", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local-mode session without `spark.checkpoint.dir` gets a fresh temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="cairngraph-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there.

    Level loops and frames with several consumers use this, so that a lost executor costs a
    re-read and not the whole lineage.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *order: str) -> DataFrame:
    """Write `df` to the shared folder as Parquet, in the order of the columns named, and read it again.

    For tables that are read many times by a key: a reader's filters go to the files and skip row groups by their least
    and greatest key, only asked columns are read, and joins know the size.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    placed.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def compact(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder as compressed Parquet and read it again: a few times smaller than a checkpoint."""
    path = f"{folder or shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """`compact` into a folder of its own, which goes at the end; what is read after that has to be written elsewhere."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df: compact(df, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Of each query that ends inside, executors drop the shuffle files at once and not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship_with_tasks(module: str) -> None:
    """Send this module's functions to the Python workers with the task itself.

    Jobs then also run where the package is not installed on the executors.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
