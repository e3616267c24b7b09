"""Queries of the scan, exchange and snapshot operators."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from cairngraph.operators import lifecycle
from cairngraph.plans import exchange_jobs
from cairngraph.plans.registry import query
from cairngraph.session import shared_dir
from cairngraph.sources import exchange, files, snapshots

SCAN_FILTER = """
    not regexp_matches(path, '(^|/)([.]git|node_modules|__pycache__|vendor|[.]tmp-nmem)/')"""
EXT = "lower(regexp_extract(path, '[^/]([.][^./]+)$', 1))"
SUPPORTED = f"{EXT} in ('.js', '.jsx', '.ts', '.tsx', '.py')"
PLANNED = f"{EXT} in ('.go', '.rs', '.java', '.c', '.cpp', '.rb', '.php')"


@query(
    "src01_scan_files",
    f"""select path, length, case {EXT} when '.js' then 'javascript' when '.jsx' then 'javascript'
          when '.py' then 'python' else 'typescript' end as language
        from files where {SCAN_FILTER} and {SUPPORTED}""",
    "files",
)
def scan_files(t):
    return files.scan_files(t.files).select("path", "length", "language")


KINDS = f"""
    found as (select path, length from files where {SCAN_FILTER} and {SUPPORTED}),
    planned as (select path, length, case {EXT} when '.go' then 'go' when '.rs' then 'rust' else 'php' end
        as language
      from files where {SCAN_FILTER} and {PLANNED})"""


@query(
    "src02_scan_report",
    f"""with {KINDS.strip()}
        select case when n > 0 then 'ok' else 'unsupported' end as outcome, n as supported_files,
          (select count(*) from planned) as planned_files,
          (select string_agg(language, ',' order by language)
           from (select distinct language from planned) l) as planned_languages,
          false as truncated, cast(0 as bigint) as oversized_files
        from (select count(*) as n from found) x""",
    "files",
)
def scan_report(t):
    report, _ = files.scan_report(t.files)
    return report.withColumn("planned_languages", F.array_join("planned_languages", ","))


@query("src02_planned_files", f"with {KINDS.strip()} select path, language from planned", "files")
def planned_files(t):
    return files.scan_report(t.files)[1]


@query(
    "src02_scan_limits",
    f"""with {KINDS.strip()},
          fits as (select path, row_number() over (order by path) as rn from found where length <= 90000),
          stop as (select max(path) as p from fits where rn = 40)
        select 'ok' as outcome, least(count(*), 40) as supported_files, count(*) > 40 as truncated,
          (select count(*) from planned, stop
           where length <= 90000 and (stop.p is null or path < stop.p)) as planned_files,
          (select count(*) from found where length > 90000)
            + (select count(*) from planned where length > 90000) as oversized_files
        from fits""",
    "files",
)
def scan_limits(t):
    """A caller's own limits, and what they left out."""
    report, _ = files.scan_report(t.files, max_files=40, max_size=90_000)
    return report.drop("planned_languages")


@query(
    "src03_scan_fibers",
    """select id, brain_id, strftime(created_at, '%Y-%m-%d') as created_at,
          strftime(last_conducted, '%Y-%m-%d') as last_conducted
        from fibers where brain_id = 'b:3' and last_conducted is not null""",
    "fibers",
)
def scan_fibers(t):
    found = exchange.scan_fibers(t.fibers, "b:3")
    return found.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "last_conducted")}
    )


CATALOG = {
    "c_custkey": "bigint",
    "c_name": "text",
    "c_mktsegment": "USER-DEFINED",
    "c_acctbal": "double precision",
    "c_tags": "ARRAY",
    "c_comment": "text",
}


@query("src04_reconcile", "select c_custkey, c_name, c_acctbal from customer")
def reconcile(t):
    return exchange.reconcile(t.customer, CATALOG)[0]


@query(
    "src05_chunk_export",
    """select conv_id, turn, cast(floor((rn - 1) / 100) + 1 as bigint) as batch_no,
          cast(floor((rn - 1) / 300) + 1 as bigint) as file_no
        from (select conv_id, turn, row_number() over (order by conv_id, turn) as rn
              from conversations)""",
)
def chunk_export(t):
    keyed = t.conversations.select("conv_id", "turn")
    return exchange.chunk_export(keyed, ["conv_id", "turn"])


NUMBERED = """
    numbered as (select *, row_number() over (order by conv_id, turn, role) as rn, count(*) over () as total
      from conversations)"""


@query(
    "src05_sql_text",
    f"""with {NUMBERED.strip()}
        select line, count(*) as n from (
          select '-- chunk ' || cast(cast(floor((rn - 1) / 300) + 1 as bigint) as varchar) as line
          from numbered where (rn - 1) % 300 = 0
          union all
          select 'INSERT INTO "talks" ("conv_id", "turn", "role") VALUES' from numbered where (rn - 1) % 100 = 0
          union all
          select 'ON CONFLICT DO NOTHING;' from numbered where (rn - 1) % 100 = 0
          union all
          select concat('  (', cast(conv_id as varchar), ', ', cast(turn as varchar), ', ', chr(39), role, chr(39), ')',
            case when rn % 100 = 0 or rn = total then '' else ',' end) from numbered) x
        group by line""",
)
def sql_text(t):
    folder = f"{shared_dir(t.spark)}/sql-{uuid.uuid4().hex}"
    target = {"conv_id": "bigint", "turn": "integer", "role": "text"}
    talks = t.conversations.select(*target)
    exchange.write_sql_chunks(talks, "talks", target, ["conv_id", "turn", "role"], folder)
    lines = t.spark.read.text(f"{folder}/table=talks")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src06_sql_literal",
    """select k, concat('  (', cast(k as varchar), ', ',
          case when synced is null then 'NULL' when synced <> 0 then 'TRUE' else 'FALSE' end, ', ',
          case when int_text is null then 'NULL' else concat('''', int_text, '''') end, ', ',
          concat('''', replace(label, '''', ''''''), ''''), ')') as values_sql
        from dirty""",
    "dirty",
)
def sql_literal(t):
    target = {"k": "bigint", "synced": "integer", "int_text": "text", "label": "text"}
    rows = t.dirty.select("k", "synced", "int_text", "label")
    return exchange.insert_rows(rows, target).select("k", "values_sql")


@query(
    "src04_column_report",
    """select column_name, case when column_name in ('c_custkey', 'c_name', 'c_acctbal') then 'common'
          when column_name = 'c_mktsegment' then 'skipped-type' else 'source-only' end as side
        from (describe customer)
        union all select 'c_comment', 'target-only'""",
)
def column_report(t):
    return exchange.reconcile(t.customer, CATALOG)[1]


MIGRATED = {
    "brains": {"id": "text", "name": "text", "config": "jsonb", "created_at": "timestamp with time zone", "updated_at": "timestamp with time zone"},
    "neurons": {"id": "text", "brain_id": "text", "type": "text", "content": "text", "created_at": "timestamp with time zone", "embedding": "USER-DEFINED"},
}


@query(
    "src07_migrate",
    """select 'brains' as table_name, count(*) as ok, cast(0 as bigint) as err, 'OK' as status, count(*) as loaded,
          cast(0 as bigint) as quarantined from brains
        union all
        select 'neurons', count(*) filter (access_frequency % 7 <> 0), count(*) filter (access_frequency % 7 = 0), 'DIFF',
          count(*) filter (access_frequency % 7 <> 0), count(*) filter (access_frequency % 7 = 0) from neurons""",
    "brains neurons",
)
def migrated(t):
    """A whole migration: columns reconciled, values coerced, bad rows kept apart, counts verified."""
    day = F.lit("2024-01-05")
    brains = t.brains.select("id", F.col("owner_id").alias("name"), F.lit("{}").alias("config"), day.alias("created_at"), day.alias("updated_at"))
    when = F.when(F.col("access_frequency") % 7 == 0, "soon").otherwise(day)
    neurons = t.neurons.select("id", "brain_id", "type", "content", when.alias("created_at"), F.lit("x").alias("embedding"), F.lit(1).alias("legacy"))
    loaded, report, bad = exchange_jobs.migrate({"brains": brains, "neurons": neurons}, MIGRATED)
    lost = bad.groupBy("table_name").agg(F.count(F.lit(1)).alias("quarantined"))
    sizes = exchange.table_counts(loaded, "loaded")
    whole = report.join(sizes, "table_name").join(lost, "table_name", "left")
    return whole.select("table_name", "ok", "err", "status", "loaded", F.coalesce("quarantined", F.lit(0)).alias("quarantined"))


def _store(t):
    return {"brains": t.brains, "fibers": t.fibers, "fiber_neurons": t.fiber_neurons}


@query(
    "src07_load_tables",
    """select 'brains' as table_name, count(*) as ok, cast(0 as bigint) as err,
          count(*) as loaded from brains
        union all
        select 'fibers', 2 * count(*), cast(0 as bigint), count(*) from fibers
        union all
        select 'fiber_neurons', count(*) filter (neuron_id <> 'p:0'),
          count(*) filter (neuron_id = 'p:0'), count(*) filter (neuron_id <> 'p:0')
        from fiber_neurons""",
    "brains fibers fiber_neurons",
)
def load_tables(t):
    source = _store(t)
    source["fibers"] = source["fibers"].unionByName(t.fibers)
    # Rows without a key are errors; here they come from the anchors of one node.
    source["fiber_neurons"] = source["fiber_neurons"].withColumn(
        "neuron_id", F.when(F.col("neuron_id") != "p:0", F.col("neuron_id"))
    )
    loaded, report = exchange.load_tables(source, {})
    sizes = exchange.table_counts(loaded, "loaded")
    return report.join(sizes, "table_name").select("table_name", "ok", "err", "loaded")


@query(
    "src07_loaded_rows",
    """select brain_id, fiber_id, neuron_id from fiber_neurons where neuron_id <> 'p:0' and neuron_id not like '%7'""",
    "fiber_neurons",
)
def loaded_rows(t):
    """Rows without a whole key are left out, rows that come twice are one."""
    key = F.when((F.col("neuron_id") != "p:0") & ~F.col("neuron_id").endswith("7"), F.col("neuron_id"))
    rows = t.fiber_neurons.withColumn("neuron_id", key)
    loaded, _ = exchange.load_tables({"fiber_neurons": rows.unionByName(rows)}, {})
    return loaded["fiber_neurons"].select("brain_id", "fiber_id", "neuron_id")


@query(
    "src08_verify_counts",
    """select 'brains' as table_name, a.n as source_rows, a.n as target_rows, 'OK' as status
        from (select count(*) as n from brains) a
        union all
        select 'fibers', a.n, b.n, case when b.n >= a.n then 'OK' else 'DIFF' end
        from (select count(*) as n from fibers) a,
          (select count(*) as n from fibers where last_conducted is not null) b
        union all
        select 'neurons', count(*), cast(0 as bigint), 'DIFF' from neurons
        union all
        select 'gaps', cast(0 as bigint), count(*), 'OK' from gaps""",
    "brains fibers neurons gaps",
)
def verify_counts(t):
    # one table is missing in the target, one in the source
    source = {"brains": t.brains, "fibers": t.fibers, "neurons": t.neurons}
    target = {"brains": t.brains, "fibers": t.fibers.filter("last_conducted is not null"), "gaps": t.gaps}
    return exchange.verify_counts(source, target)


@query(
    "src09_write_backup",
    """select id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as created_at,
          strftime(last_conducted, '%Y-%m-%dT%H:%M:%S') || '+00:00' as last_conducted,
          case when year(last_conducted) < 1998 then 'pre2026' else 'before-created' end as reason
        from fibers
        where year(last_conducted) < 1998 or last_conducted < created_at""",
    "fibers",
)
def write_backup(t):
    candidates = lifecycle.repair_candidates(t.fibers, floor=1998)
    rows = candidates.select("id", "created_at", "last_conducted", "reason")
    folder = f"{shared_dir(t.spark)}/backup-{uuid.uuid4().hex}"
    path = exchange.write_backup(rows, folder, datetime(2026, 1, 1))
    return t.spark.read.schema(
        "id string, created_at string, last_conducted string, reason string"
    ).json(path)


@query(
    "src10_snapshot_copy",
    """select 'fibers' as table_name, brain_id, count(*) as rows from fibers
        where brain_id <> 'b:2' group by brain_id
        union all
        select 'fibers', 'b:copy', count(*) from fibers where brain_id = 'b:1'
        union all
        select 'fiber_neurons', brain_id, count(*) from fiber_neurons
        where brain_id <> 'b:2' group by brain_id
        union all
        select 'fiber_neurons', 'b:copy', count(*) from fiber_neurons where brain_id = 'b:1'""",
    "fibers fiber_neurons",
)
def snapshot_copy(t):
    tables = {"fibers": t.fibers, "fiber_neurons": t.fiber_neurons}
    snapshot = snapshots.export_brain(tables, "b:1")
    merged = snapshots.import_brain(tables, snapshot, "b:copy")
    left = snapshots.clear_brain(merged, "b:2")
    counted = [
        frame.groupBy("brain_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "brain_id", "rows")
        for name, frame in left.items()
    ]
    return counted[0].unionByName(counted[1])


@query(
    "src10_copied_rows",
    """select brain_id, fiber_id, neuron_id from fiber_neurons where brain_id <> 'b:2'
        union all
        select 'b:copy', fiber_id, neuron_id from fiber_neurons where brain_id = 'b:1'""",
    "fiber_neurons",
)
def copied_rows(t):
    tables = {"fiber_neurons": t.fiber_neurons}
    merged = snapshots.import_brain(tables, snapshots.export_brain(tables, "b:1"), "b:copy")
    return snapshots.clear_brain(merged, "b:2")["fiber_neurons"].select("brain_id", "fiber_id", "neuron_id")


BRAIN = "concat('b:', cast(cast(substring(id, 3) as bigint) % 3 as string))"
MERGED = f"""
    l as (select {BRAIN} as brain_id, * from snap_local),
    i as (select {BRAIN} as brain_id, * from snap_incoming),
    m as (select 'b:1' as brain_id, coalesce(l.id, i.id) as id,
        case when l.id is null or take then i.content else l.content end as content,
        case when l.id is null or take then i.weight else l.weight end as weight,
        case when l.id is null or take then i.updated_at else l.updated_at end as updated_at
      from (select * from l where brain_id = 'b:1') l full join (select * from i where brain_id = 'b:1') i on l.id = i.id,
        lateral (select coalesce(l.id = i.id and (l.content is distinct from i.content or l.weight is distinct from i.weight)
          and i.updated_at > l.updated_at, false) as take) x)"""


def synced(t):
    tables = [{"neurons": frame.select(F.expr(BRAIN).alias("brain_id"), "*")} for frame in (t.snap_local, t.snap_incoming)]
    return exchange_jobs.sync(*tables, "b:1", "prefer_recent")


@query(
    "src10_sync_stores",
    f"""with {MERGED.strip()}
        select 'local' as store, * from m union all select 'local', * from l where brain_id <> 'b:1'
        union all select 'remote', * from m union all select 'remote', * from i where brain_id <> 'b:1'""",
    "snap_local snap_incoming",
)
def sync_stores(t):
    local, remote, _ = synced(t)
    sides = [side["neurons"].select(F.lit(name).alias("store"), "brain_id", "id", "content", "weight", "updated_at") for name, side in (("local", local), ("remote", remote))]
    return sides[0].unionByName(sides[1])


@query(
    "src10_sync_report",
    f"""with {MERGED.strip()}, c as (
          select l.id as a, i.id as b, l.content is distinct from i.content or l.weight is distinct from i.weight as differs,
            i.updated_at > l.updated_at as later
          from (select * from l where brain_id = 'b:1') l full join (select * from i where brain_id = 'b:1') i on l.id = i.id)
        select 'neurons' as table_name, count(*) filter (a is null) as added, count(*) filter (a = b and differs and later) as updated,
          count(*) filter (a = b and not (differs and later)) as skipped, count(*) filter (a = b and differs) as conflicts,
          true as pulled, true as pushed from c""",
    "snap_local snap_incoming",
)
def sync_report(t):
    return synced(t)[2]


@query(
    "src09_repair_run",
    """select count(*) filter (bad) as candidate_count, count(*) filter (bad) as updated_count, count(*) as fibers,
          count(*) filter (bad) as backed_up
        from (select coalesce((brain_id = 'b:3') and (year(last_conducted) < 1998 or last_conducted < created_at), false) as bad
              from fibers) x""",
    "fibers",
)
def repair_run(t):
    folder = f"{shared_dir(t.spark)}/repair-{uuid.uuid4().hex}"
    fixed, summary, _ = exchange_jobs.run_repair(t.fibers, "b:3", floor=1998, apply=True, backup_dir=folder, now=datetime(2026, 1, 1))
    held = t.spark.read.schema("id string").json(summary["backup_path"])
    kept = fixed.agg(F.count(F.lit(1)).alias("fibers")).withColumns({c: F.lit(summary[c]).cast("bigint") for c in ("candidate_count", "updated_count")})
    return kept.join(held.agg(F.count(F.lit(1)).alias("backed_up")))


LOOSE = {
    "k": "bigint",
    "int_text": "integer",
    "bool_text": "boolean",
    "float_text": "double precision",
}
INT_OK = "regexp_full_match(trim(int_text), '[+-]?[0-9]+(_[0-9]+)*')"
INT_VALUE = f"case when {INT_OK} then cast(replace(trim(int_text), '_', '') as bigint) end"
FLOAT_VALUE = "try_cast(nullif(trim(float_text), '') as double)"
BOOL_VALUE = "lower(bool_text) in ('true', '1', 'yes')"


@query(
    "src11_quarantine_load",
    f"""select k, {INT_VALUE} as int_text, {BOOL_VALUE} as bool_text,
          {FLOAT_VALUE} as float_text
        from dirty where {INT_VALUE} is not null and {BOOL_VALUE} is not null""",
    "dirty",
)
def quarantine_load(t):
    rows = t.dirty.select(*LOOSE)
    return exchange.load_with_quarantine(rows, LOOSE, ["int_text", "bool_text"], ["k"])[0]


JUDGED = f"""
    judged as (select k, concat_ws(',', case when {INT_VALUE} is null then 'int_text' end,
        case when {BOOL_VALUE} is null then 'bool_text' end) as error, int_text, bool_text, float_text from dirty)"""


@query(
    "src11_quarantine_report",
    f"""with {JUDGED.strip()}
        select j.k, j.error, c.ok, c.err
        from (select * from judged where error <> '' order by k limit 3) j,
          (select count(*) filter (error = '') as ok, count(*) filter (error <> '') as err
           from judged) c""",
    "dirty",
)
def quarantine_report(t):
    rows = t.dirty.select(*LOOSE)
    _, bad, report = exchange.load_with_quarantine(
        rows, LOOSE, ["int_text", "bool_text"], ["k"]
    )
    counts = report.select(F.struct("ok", "err")).scalar()
    samples = exchange.first_errors(bad, ["k"])
    return samples.withColumn("c", counts).select("k", "error", "c.ok", "c.err")


@query(
    "src11_quarantined_rows",
    f"""with {JUDGED.strip()}
        select k, error, int_text, bool_text, float_text from judged where error <> ''""",
    "dirty",
)
def quarantined_rows(t):
    """All rows that could not be loaded, as they came."""
    rows = t.dirty.select(*LOOSE)
    _, bad, _ = exchange.load_with_quarantine(rows, LOOSE, ["int_text", "bool_text"], ["k"])
    texts = [F.get_json_object("raw", f"$.{c}").alias(c) for c in ("int_text", "bool_text", "float_text")]
    return bad.select("k", "error", *texts)
