"""Moving tables between stores: reconcile, coerce, chunk, load, verify, back up."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairngraph.functions import scalars as S
from cairngraph.operators.common import first_by, union_all, with_position
from cairngraph.operators.tables import insert_ignore, sortable
from cairngraph.schemas import BOOLEAN_COLUMNS, LOAD_ORDER, PRIMARY_KEYS, SKIPPED_TARGET_TYPES
from cairngraph.session import shared_dir

BATCH_ROWS = 100
MAX_ROWS_PER_FILE = 300
ERROR_SAMPLES = 3


def scan_fibers(fibers: DataFrame, brain_id: str) -> DataFrame:
    """Used fibers of one brain, oldest use first."""
    return (
        fibers.filter((F.col("brain_id") == brain_id) & F.col("last_conducted").isNotNull())
        .select("id", "brain_id", "created_at", "last_conducted")
        .orderBy("last_conducted", "id")
    )


# --- schema reconciliation ------------------------------------------------------------------


def reconcile(df: DataFrame, target: dict[str, str]) -> tuple[DataFrame | None, DataFrame]:
    """Columns known on both sides in source order, and a report of every column.

    `target` maps column names to catalog types. The frame is None when nothing is in common.
    """
    rows = []
    common = []
    for name in df.columns:
        if name not in target:
            rows.append((name, "source-only"))
        elif target[name] in SKIPPED_TARGET_TYPES:
            rows.append((name, "skipped-type"))
        else:
            rows.append((name, "common"))
            common.append(name)
    for name, kind in target.items():
        if name not in df.columns and kind not in SKIPPED_TARGET_TYPES:
            rows.append((name, "target-only"))
    report = df.sparkSession.createDataFrame(rows, "column_name string, side string")
    return (df.select(*common) if common else None), report


def reconcile_tables(
    tables: dict[str, DataFrame], catalog: dict[str, dict[str, str]]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Reconciled tables and the column report of all.

    Tables the catalog does not know, empty ones and those with nothing in common are left out.
    """
    kept, reports = {}, []
    for name, frame in tables.items():
        if name not in catalog:
            continue
        common, report = reconcile(frame, catalog[name])
        reports.append(report.select(F.lit(name).alias("table_name"), "column_name", "side"))
        if common is not None and not frame.isEmpty():
            kept[name] = common
    if not reports:
        raise ValueError("no table is known to the catalog")
    return kept, union_all(reports)


# --- coercion and quarantine ----------------------------------------------------------------

_NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)


def source_kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, _NUMERIC):
        return "number"
    if isinstance(data_type, T.BinaryType):
        return "binary"
    return "string" if isinstance(data_type, T.StringType) else "other"


def coerce(c: Column, data_type: T.DataType, target_type: str) -> Column:
    """Value of a loosely typed column for a catalog type; what cannot be read becomes null."""
    kind = source_kind(data_type)
    target = target_type.lower()
    if target_type in SKIPPED_TARGET_TYPES:
        return F.lit(None).cast("string")
    if target == "boolean":
        return F.length(c) > 0 if kind == "binary" else S.to_bool(c, kind)
    if kind == "binary" and target in ("integer", "bigint", "smallint", "double precision", "real", "numeric"):
        c, kind = c.cast("string"), "string"
    if target in ("integer", "bigint", "smallint"):
        return S.to_int(c, kind)
    if target in ("double precision", "real", "numeric"):
        return S.to_float(c, kind)
    if "timestamp" in target:
        return c if kind == "other" else S.to_ts(c, kind)
    return S.bytes_to_text(c) if kind == "binary" else c.cast("string")


def load_with_quarantine(
    df: DataFrame,
    target: dict[str, str],
    not_null: Sequence[str],
    key: Sequence[str],
    path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(loaded rows, quarantined rows, one-row count of ok and err), written below `path` in one pass.

    Every value is coerced on its own. A row is bad when a required column has no value left; a quarantined row is its key,
    the columns at fault (`error`) and the row as it came, as JSON (`raw`). Counts are taken while writing. Without a `path`
    the two parts lie in the shared folder.
    """
    fields = {f.name: f.dataType for f in df.schema.fields if f.name in target}
    typed = df.select(
        *[coerce(F.col(name), kind, target[name]).alias(name) for name, kind in fields.items()],
        *[F.col(k).alias(f"__key_{k}") for k in key],
        F.struct(*df.columns).alias("__row"),
    )
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in not_null]).cast("array<string>")
    )
    typed = typed.withColumn("error", F.array_join(missing, ","))
    typed = typed.withColumn("__bad", F.col("error") != "")
    typed = typed.withColumn("raw", F.when(F.col("__bad"), F.to_json("__row"))).drop("__row")
    path = path or f"{shared_dir(df.sparkSession)}/load-{uuid.uuid4().hex}"
    seen = Observation()
    typed.observe(
        seen, F.count_if(~F.col("__bad")).alias("ok"), F.count_if(F.col("__bad")).alias("err")
    ).write.partitionBy("__bad").parquet(path)
    counts = seen.get
    stored = df.sparkSession.read.schema(typed.schema).parquet(path)
    bad = stored.filter("__bad").select(*[F.col(f"__key_{k}").alias(k) for k in key], "error", "raw")
    report = df.sparkSession.createDataFrame([(counts.get("ok") or 0, counts.get("err") or 0)], "ok bigint, err bigint")
    return stored.filter("not __bad").select(*fields), bad, report


def first_errors(bad: DataFrame, key: Sequence[str], n: int = ERROR_SAMPLES) -> DataFrame:
    """The first quarantined rows by key, as a sample to look at."""
    return bad.orderBy(*key).limit(n).select(*key, "error")


# --- SQL text chunks ------------------------------------------------------------------------


def sql_literal(c: Column, name: str, target_type: str, data_type: T.DataType) -> Column:
    """The value as SQL text."""
    kind = source_kind(data_type)
    if name in BOOLEAN_COLUMNS or target_type == "boolean":
        truth = {
            "boolean": lambda: c,
            "number": lambda: c != 0,
            "binary": lambda: F.length(c) > 0,
        }.get(kind, lambda: F.length(c.cast("string")) > 0)()
        text = F.when(truth, F.lit("TRUE")).otherwise(F.lit("FALSE"))
    elif kind == "number":
        text = c.cast("string")
    else:
        plain = c.cast("string")
        if kind == "binary":
            plain = F.make_valid_utf8(plain)
        text = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(c.isNull(), F.lit("NULL")).otherwise(text)


def chunk_export(
    df: DataFrame,
    key: Sequence[str],
    batch: int = BATCH_ROWS,
    max_rows: int = MAX_ROWS_PER_FILE,
    whole: bool = False,
) -> DataFrame:
    """Adds `batch_no` and `file_no` (from 1): full batches packed in files of at most `max_rows`.

    A short last batch joins the file before it when it still fits. `whole` keeps one file.
    """
    placed = with_position(df, key).withColumn(
        "batch_no", F.floor(F.col("position") / batch) + 1
    )
    if whole:
        return placed.drop("position").withColumn("file_no", F.lit(1).cast("bigint"))
    per_file = max(1, max_rows // batch)
    total = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    full = F.floor(total / batch)
    rest = total % batch
    fits_before = (
        (F.col("batch_no") == full + 1)
        & (full > 0)
        & (full % per_file == 0)
        & (rest + per_file * batch <= max_rows)
    )
    file_no = F.floor((F.col("batch_no") - 1) / per_file) + 1
    return placed.drop("position").withColumn(
        "file_no", F.when(fits_before, file_no - 1).otherwise(file_no)
    )


def insert_rows(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Adds `values_sql`: the row as a parenthesised list of literals in column order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    literals = [sql_literal(F.col(c), c, target[c], types[c]) for c in df.columns if c in target]
    return df.withColumn(
        "values_sql", F.concat(F.lit("  ("), F.concat_ws(", ", *literals), F.lit(")"))
    )


def write_sql_chunks(
    df: DataFrame,
    table: str,
    target: dict[str, str],
    key: Sequence[str],
    out_dir: str,
    batch: int = BATCH_ROWS,
    max_rows: int = MAX_ROWS_PER_FILE,
) -> None:
    """All chunks as SQL text below `out_dir/table=<name>`, in order, many in each file.

    Files follow the amount of data and not the number of chunks; a chunk stays whole and begins with a line that names it. A
    statement holds at most `batch` rows, so the text built in one row stays small. A task that runs again replaces
    what it wrote.
    """
    columns = ", ".join(f'"{c}"' for c in df.columns if c in target)
    head = f'INSERT INTO "{table}" ({columns}) VALUES\n'
    rows = insert_rows(df, target).select(*key, "values_sql")
    packed = chunk_export(rows, key, batch, max_rows)
    ordered = F.array_sort(F.collect_list(F.struct(*key, "values_sql")))
    statements = packed.groupBy("file_no", "batch_no").agg(ordered.alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["values_sql"]), ",\n")
    first = F.col("batch_no") == F.min("batch_no").over(Window.partitionBy("file_no"))
    name = F.when(first, F.concat(F.lit("-- chunk "), F.col("file_no").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    text = F.concat(name, F.lit(head), body, F.lit("\nON CONFLICT DO NOTHING;"))
    (
        statements.select("file_no", "batch_no", text.alias("value"))
        .repartitionByRange("file_no")
        .sortWithinPartitions("file_no", "batch_no")
        .select("value")
        .write.mode("overwrite")
        .text(f"{out_dir}/table={table}")
    )


# --- ordered load, verification, versions ---------------------------------------------------


def load_tables(
    source: dict[str, DataFrame],
    target: dict[str, DataFrame],
    order: Sequence[str] = LOAD_ORDER,
    keys: dict[str, Sequence[str]] | None = None,
    clear: bool = True,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """New tables and a report (position, table_name, ok, err), parents before children.

    Rows without a complete key are errors. Rows whose key exists are ignored. With `clear` the
    tables start empty, which for a new version means starting from the source alone.
    """
    keys = keys or PRIMARY_KEYS
    loaded = dict(target)
    reports = []
    for position, name in enumerate(t for t in order if t in source):
        frame, key = source[name], list(keys[name])
        usable = frame.dropna(subset=key)
        if clear or name not in target:
            loaded[name] = first_by(usable, key, sortable(usable, key))
        else:
            loaded[name] = insert_ignore(target[name], usable, key)
        no_key = F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) == 1
        reports.append(
            frame.agg(F.count_if(~no_key).alias("ok"), F.count_if(no_key).alias("err")).select(
                F.lit(position).alias("position"), F.lit(name).alias("table_name"), "ok", "err"
            )
        )
    return loaded, union_all(reports)


def table_counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    return union_all(
        [
            frame.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name)
            for t, frame in tables.items()
        ]
    )


def verify_counts(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Per table of either side: source rows, target rows, OK when the target has the table and at least as many."""
    joined = table_counts(target, "target_rows").join(
        table_counts(source, "source_rows"), "table_name", "full_outer"
    )
    n_source, n_target = F.coalesce("source_rows", F.lit(0)), F.coalesce("target_rows", F.lit(0))
    enough = F.col("target_rows").isNotNull() & (n_target >= n_source)
    return joined.select(
        "table_name",
        n_source.alias("source_rows"),
        n_target.alias("target_rows"),
        F.when(enough, F.lit("OK")).otherwise(F.lit("DIFF")).alias("status"),
    )


def write_version(tables: dict[str, DataFrame], base_dir: str, version: str) -> str:
    """Write all tables as one new version folder; earlier versions stay readable, and a version is never written over."""
    path = f"{base_dir.rstrip('/')}/version={version}"
    for name, frame in tables.items():
        frame.write.parquet(f"{path}/{name}")
    return path


def read_version(
    spark: SparkSession, base_dir: str, version: str, names: Iterable[str]
) -> dict[str, DataFrame]:
    path = f"{base_dir.rstrip('/')}/version={version}"
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


# --- backup ---------------------------------------------------------------------------------


def backup_rows(df: DataFrame) -> DataFrame:
    """The rows as they are backed up: timestamps as ISO text in UTC."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            S.utc_iso(f.name).alias(f.name) if isinstance(f.dataType, stamps) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_backup(df: DataFrame, out_dir: str, now: datetime) -> str:
    path = f"{out_dir.rstrip('/')}/fibers-before-repair-{now.strftime('%Y-%m-%d-%H%M%S')}.json"
    backup_rows(df).write.mode("overwrite").json(path)
    return path


# --- database tables ------------------------------------------------------------------------


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """A table behind JDBC. With a numeric column and its bounds it is read in parallel ranges.

    Credentials come in through `options` and the driver jar through the session.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**options).load()
