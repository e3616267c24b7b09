"""Queries of roll-ups, merges, lifecycle changes, checks and the change feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairngraph.operators import checks, lifecycle, rollup, tables
from cairngraph.operators.common import first_by
from cairngraph.operators.resolve import with_symbol_id
from cairngraph.plans.registry import query
from cairngraph.schemas import DEFAULTS
from cairngraph.session import shared_dir
from cairngraph.sources.files import scan_report
from cairngraph.streaming import changes

# --- roll-ups -------------------------------------------------------------------------------


@query(
    "ag01_generation_counts",
    """select generation_id, project_path, symbols, coalesce(edges, 0) as edges from (
          select generation_id, project_path, count(*) as symbols from nodes
          group by generation_id, project_path) n
        left join (select generation_id, project_path, count(*) as edges from store_edges
          group by generation_id, project_path) e using (generation_id, project_path)""",
    "nodes store_edges",
)
def generation_counts(t):
    return rollup.generation_counts(t.nodes, t.store_edges)


@query(
    "ag02_brain_stats",
    """select n.brain_id, n.neurons, s.synapses, f.fibers from
          (select brain_id, count(*) as neurons from neurons group by brain_id) n
          join (select brain_id, count(*) as synapses from edges join neurons on src = id
            group by brain_id) s using (brain_id)
          join (select brain_id, count(*) as fibers from fibers group by brain_id) f
            using (brain_id)""",
    "neurons edges fibers",
)
def brain_stats(t):
    synapses = t.edges.join(t.neurons, F.col("src") == F.col("id")).select("brain_id")
    return rollup.brain_stats(t.neurons, synapses, t.fibers)


@query(
    "ag03_index_report",
    """select 'success' as status, 'g1_0' as generation_id,
          (select count(*) from nodes where generation_id = 'g1_0') as symbols,
          (select count(*) from store_edges where generation_id = 'g1_0') as edges,
          cast(0 as bigint) as skipped""",
    "nodes store_edges",
)
def index_report(t):
    scan, _ = scan_report(t.files)
    gens = _counted_generations(t)
    report = rollup.index_report(scan, gens.filter("generation_id = 'g1_0'"))
    return report.select("status", "generation_id", "symbols", "edges", "skipped")


def _counted_generations(t):
    counts = rollup.generation_counts(t.nodes, t.store_edges)
    return t.generations.join(counts, ["generation_id", "project_path"]).select(
        "generation_id",
        "project_path",
        "status",
        F.col("symbols").alias("symbol_count"),
        F.col("edges").alias("edge_count"),
        F.lit(0).cast("bigint").alias("skipped_files"),
        F.lit(None).cast("string").alias("error"),
    )


FLOOR = "year(last_conducted) < 1998"


@query(
    "ag05_repair_summary",
    f"""select reason, count(*) as candidates from (
          select case when {FLOOR} then 'pre2026' when last_conducted < created_at
            then 'before-created' end as reason from fibers) x
        where reason is not null group by reason""",
    "fibers",
)
def repair_summary(t):
    return rollup.repair_summary(lifecycle.repair_candidates(t.fibers, floor=1998))[0]


@query(
    "ag05_repair_samples",
    f"""select id, case when {FLOOR} then 'pre2026' else 'before-created' end as reason,
          strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as created_at,
          strftime(last_conducted, '%Y-%m-%dT%H:%M:%S') || '+00:00' as last_conducted,
          strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as normalized_last_conducted
        from fibers f where {FLOOR} or f.last_conducted < f.created_at
        order by f.last_conducted, f.id limit 10""",
    "fibers",
)
def repair_samples(t):
    return rollup.repair_summary(lifecycle.repair_candidates(t.fibers, floor=1998), 10)[1]


@query(
    "ag06_hot_slots",
    """select brain_id, cast(slot as integer) as slot, id, round(score, 6) as score from (
          select brain_id, id, salience as score, row_number() over (partition by brain_id
            order by salience desc, id) as slot from fibers) x where slot <= 20""",
    "fibers",
)
def hot_slots(t):
    scored = t.fibers.withColumn("score", F.col("salience"))
    best = rollup.hot_slots(scored, 20, tie="id")
    return best.select("brain_id", "slot", "id", F.round("score", 6).alias("score"))


@query(
    "ag07_gap_ranking",
    """select brain_id, id, priority, cast(rank as integer) as rank from (
          select *, row_number() over (partition by brain_id order by priority desc, id) as rank
          from gaps where resolved_at is null) x where rank <= 15""",
    "gaps",
)
def gap_ranking(t):
    return rollup.rank_gaps(t.gaps, 15).select("brain_id", "id", "priority", "rank")


@query(
    "ag08_cognitive_rollup",
    """select brain_id, status, count(*) as states, round(avg(confidence), 6) as mean_confidence,
          cast(sum(evidence_for_count) as bigint) as evidence_for,
          cast(sum(evidence_against_count) as bigint) as evidence_against
        from cognitive group by brain_id, status""",
    "cognitive",
)
def cognitive_rollup(t):
    rolled = rollup.cognitive_rollup(t.cognitive)
    return rolled.withColumn("mean_confidence", F.round("mean_confidence", 6))


# --- insert, upsert, merge, dedupe ----------------------------------------------------------


@query(
    "st01_insert_ignore",
    """select id, content, weight, updated_at from snap_local
        union all
        select id, content, weight, updated_at from snap_incoming
        where id not in (select id from snap_local)""",
    "snap_local snap_incoming",
)
def insert_ignore(t):
    # Every incoming row comes twice, the second time later.
    later = t.snap_incoming.withColumn("updated_at", F.col("updated_at") + 1000)
    twice = later.unionByName(t.snap_incoming)
    return tables.insert_ignore(t.snap_local, twice, ["id"], ["updated_at"])


@query(
    "st02_upsert",
    """select id, content, weight, updated_at from snap_incoming
        union all
        select id, content, weight, updated_at from snap_local
        where id not in (select id from snap_incoming)""",
    "snap_local snap_incoming",
)
def upsert(t):
    return tables.upsert(t.snap_local, t.snap_incoming, ["id"])


def _merge_sql(wins: str) -> str:
    take = f"l.id is null or (i.id is not null and {CONFLICT} and {wins})"
    picked = ", ".join(
        f"case when {take} then i.{c} else l.{c} end as {c}"
        for c in ("id", "content", "weight", "updated_at")
    )
    return f"select {picked} from snap_local l full join snap_incoming i on l.id = i.id"


CONFLICT = "(l.content <> i.content or l.weight <> i.weight)"
WINS = {
    "prefer_local": "false",
    "prefer_remote": "true",
    "prefer_recent": "i.updated_at > l.updated_at",
    "prefer_stronger": "i.weight > l.weight",
}


def _register_merge(strategy: str) -> None:
    @query(f"st03_merge_{strategy}", _merge_sql(WINS[strategy]), "snap_local snap_incoming")
    def merge(t):
        return tables.merge_snapshots(t.snap_local, t.snap_incoming, strategy)[0]


for _strategy in tables.MERGE_STRATEGIES:
    _register_merge(_strategy)


@query(
    "st03_merge_report",
    f"""select count(*) filter (l.id is null) as added,
          count(*) filter (l.id = i.id and {CONFLICT} and i.updated_at > l.updated_at) as updated,
          count(*) filter (l.id = i.id and not ({CONFLICT} and i.updated_at > l.updated_at))
            as skipped,
          count(*) filter (l.id = i.id and {CONFLICT}) as conflicts
        from snap_local l full join snap_incoming i on l.id = i.id""",
    "snap_local snap_incoming",
)
def merge_report(t):
    return tables.merge_snapshots(t.snap_local, t.snap_incoming, "prefer_recent")[1]


@query(
    "st04_dedupe_content",
    """select lang, min(doc_id) as doc_id, count(*) as copies from documents
        group by lang, text""",
)
def dedupe_content(t):
    _, groups = tables.dedupe_content(t.documents, "lang", "text", ["doc_id"])
    return groups.select("lang", "doc_id", "copies")


@query(
    "st04_kept_documents",
    "select min(doc_id) as doc_id, min(n_chars) as n_chars from documents group by lang, text",
)
def kept_documents(t):
    kept, _ = tables.dedupe_content(t.documents, "lang", "text", ["doc_id"])
    return kept.select("doc_id", "n_chars")


@query(
    "st04_kept_with_null_order",
    """select doc_id, n from (
          select doc_id, n, row_number() over (partition by lang, text order by n nulls last, doc_id) as r
          from (select doc_id, lang, text, case when doc_id % 3 = 0 then null else n_chars + doc_id % 5 end as n
                from documents) x) y where r = 1""",
)
def kept_with_null_order(t):
    rows = t.documents.withColumn("n", F.when(F.col("doc_id") % 3 != 0, F.col("n_chars") + F.col("doc_id") % 5))
    kept, _ = tables.dedupe_content(rows, "lang", "text", ["n", "doc_id"])
    return kept.select("doc_id", "n")


# --- generations ----------------------------------------------------------------------------


@query(
    "dm01_create_generation",
    """select generation_id, project_path, status from generations
        union all
        select substring(sha256('/proj/0:2026-01-01'), 1, 16), '/proj/0', 'building'""",
    "generations",
)
def create_generation(t):
    gens = lifecycle.create_generation(t.generations, "/proj/x/../0", "2026-01-01")
    return gens.select("generation_id", "project_path", "status")


@query(
    "dm02_store_symbols",
    """select concat('new:', sid) as id, content, concat('codeintel,function,', language) as tags
        from (select sha256(concat(project, ':', language, ':', file, ':', qualified_name, ':',
                signature)) as sid, language, concat('function: ', qualified_name, ' in ', file,
                ':', cast(line as varchar)) as content,
              row_number() over (partition by file, qualified_name, signature order by line) as rn
              from defs) x where rn = 1
        """,
    "defs",
)
def store_symbols(t):
    # Equal definitions are one symbol; the one with the smallest line is stored here.
    symbols = first_by(with_symbol_id(t.defs), ["symbol_id"], ["line"])
    store = lifecycle.empty_store(t.spark)["nodes"]
    once = lifecycle.store_symbols(store, symbols, "new")
    again = lifecycle.store_symbols(once, symbols, "new")
    return again.select("id", "content", F.array_join("tags", ",").alias("tags"))


@query(
    "dm03_store_edges",
    """select sha256(concat('new:', e.src, ':', edge_type, ':', e.dst)) as id,
          concat('new:', e.src) as src, concat('new:', e.dst) as dst, edge_type, e.line
        from edges e where e.src in (select id from nodes where line > 5)
          and e.dst in (select id from nodes where line > 5)""",
    "edges nodes",
)
def store_edges(t):
    stored = t.nodes.filter("line > 5").select(F.concat(F.lit("new:"), "id").alias("id"))
    found = t.edges.select(
        F.lit("/proj").alias("project"), F.col("src").alias("source_sid"),
        F.col("dst").alias("target_sid"), F.col("edge_type").alias("type"), "line",
    )
    store = lifecycle.empty_store(t.spark)["edges"]
    kept = lifecycle.store_edges(store, found, stored, "new")
    return kept.select("id", "src", "dst", "edge_type", "line")


@query(
    "dm04_activate_generation",
    """select g.generation_id, g.project_path,
          case when g.generation_id = 'g1_1' then 'active'
            when g.project_path = '/proj/1' and g.status = 'active' then 'gc'
            else g.status end as status,
          c.n as symbol_count
        from generations g join (select generation_id, count(*) as n from nodes
          group by generation_id) c using (generation_id)""",
    "generations nodes",
)
def activate_generation(t):
    gens = _counted_generations(t)
    swapped = lifecycle.activate(gens, t.nodes, t.store_edges, "g1_1", "/proj/1")
    return swapped.select("generation_id", "project_path", "status", "symbol_count")


@query(
    "dm05_fail_generation",
    """select generation_id, case when generation_id = 'g2_1' then 'failed' else status end
            as status, case when generation_id = 'g2_1' then 'boom' end as error
        from generations""",
    "generations",
)
def fail_generation(t):
    gens = t.generations.withColumn("error", F.lit(None).cast("string"))
    return lifecycle.fail(gens, "g2_1", "boom").select("generation_id", "status", "error")


@query(
    "dm06_clear_index",
    """select 'node' as what, id as a, '' as b from nodes where project_path <> '/proj/3'
        union all
        select 'edge', src, concat(dst, edge_type) from edges
        where src in (select id from nodes where project_path <> '/proj/3')
          and dst in (select id from nodes where project_path <> '/proj/3')
        union all
        select 'generation', generation_id, '' from generations where project_path <> '/proj/3'
        union all
        select 'removed', cast((select count(*) from nodes where project_path = '/proj/3')
          + (select count(*) from generations where project_path = '/proj/3') as varchar), ''""",
    "nodes edges generations",
)
def clear_index(t):
    nodes, edges, gens, removed = lifecycle.clear_index(t.nodes, t.edges, t.generations, "/proj/3")
    none = F.lit("")
    return (
        nodes.select(F.lit("node").alias("what"), F.col("id").alias("a"), none.alias("b"))
        .union(edges.select(F.lit("edge"), "src", F.concat("dst", "edge_type")))
        .union(gens.select(F.lit("generation"), "generation_id", none))
        .union(removed.select(F.lit("removed"), F.col("removed").cast("string"), none))
    )


@query(
    "dm07_cascade_delete",
    """select 'brains' as table_name, id as brain_id, cast(1 as bigint) as rows from brains
        where owner_id <> 'u:1'
        union all
        select 'fibers', brain_id, count(*) from fibers
        where brain_id in (select id from brains where owner_id <> 'u:1') group by brain_id
        union all
        select 'fiber_neurons', brain_id, count(*) from fiber_neurons
        where brain_id in (select id from brains where owner_id <> 'u:1') group by brain_id
        union all
        select 'neurons', brain_id, count(*) from neurons
        where brain_id in (select id from brains where owner_id <> 'u:1') group by brain_id""",
    "brains fibers fiber_neurons neurons",
)
def cascade_delete(t):
    store = {
        "brains": t.brains, "fibers": t.fibers, "fiber_neurons": t.fiber_neurons,
        "neurons": t.neurons,
    }
    gone = t.brains.filter("owner_id = 'u:1'")
    left = lifecycle.cascade_delete(store, "brains", gone)
    left["brains"] = left["brains"].withColumnRenamed("id", "brain_id")
    counted = [
        left[name]
        .groupBy("brain_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "brain_id", "rows")
        for name in store
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


@query(
    "dm07_cascade_of_nodes",
    """select 'neurons' as table_name, brain_id, id as a, '' as b from neurons where access_frequency >= 25
        union all
        select 'fiber_neurons', f.brain_id, f.fiber_id, f.neuron_id from fiber_neurons f
        where not exists (select 1 from neurons n where n.brain_id = f.brain_id and n.id = f.neuron_id
          and n.access_frequency < 25)
        union all
        select 'fibers', brain_id, id, '' from fibers""",
    "fibers fiber_neurons neurons",
)
def cascade_of_nodes(t):
    """The rows themselves, after removing some nodes of every tenant."""
    store = {"fibers": t.fibers, "fiber_neurons": t.fiber_neurons, "neurons": t.neurons}
    left = lifecycle.cascade_delete(store, "neurons", t.neurons.filter("access_frequency < 25"))
    parts = [
        left["neurons"].select(F.lit("neurons").alias("table_name"), "brain_id", F.col("id").alias("a"), F.lit("").alias("b")),
        left["fiber_neurons"].select(F.lit("fiber_neurons"), "brain_id", "fiber_id", "neuron_id"),
        left["fibers"].select(F.lit("fibers"), "brain_id", "id", F.lit("")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "dm08_repair",
    f"""select id, brain_id, strftime(case when {FLOOR} or last_conducted < created_at
          then created_at else last_conducted end, '%Y-%m-%d') as last_conducted from fibers""",
    "fibers",
)
def repair(t):
    fixed, _ = lifecycle.repair(t.fibers, floor=1998, apply=True)
    return fixed.select(
        "id", "brain_id", F.date_format("last_conducted", "yyyy-MM-dd").alias("last_conducted")
    )


@query(
    "dm10_decay",
    """select neuron_id, round(coalesce(activation_level * exp(-decay_rate
          * (epoch_us(timestamp '2002-01-01') - epoch_us(last_activated)) / 3600000000.0),
          activation_level), 6) as activation_level from neuron_states""",
    "neuron_states",
)
def decay(t):
    faded = lifecycle.decay(t.neuron_states, F.lit("2002-01-01").cast("timestamp"))
    return faded.select("neuron_id", F.round("activation_level", 6).alias("activation_level"))


PRUNE_AT = "2001-01-01"


@query(
    "dm11_prune",
    f"""select e.src, e.dst, e.edge_type from edges e left join neuron_states s
          on e.src = s.neuron_id
        where not (weight < 0.4 and reinforced_count < 2 and coalesce(
          epoch_us(timestamp '{PRUNE_AT}') - epoch_us(last_activated) > 100 * 3600000000, true))""",
    "edges neuron_states",
)
def prune(t):
    used = t.neuron_states.select(F.col("neuron_id").alias("src"), "last_activated")
    at = F.lit(PRUNE_AT).cast("timestamp")
    kept = lifecycle.prune(t.edges.join(used, "src", "left"), 0.4, 100.0, 2, at)
    return kept.select("src", "dst", "edge_type")


# --- checks ---------------------------------------------------------------------------------


@query(
    "ck01_pk_violations",
    """select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
)
def pk_violations(t):
    return checks.pk_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "ck02_orphans",
    """select fiber_id, neuron_id from fiber_neurons
        where neuron_id not in (select id from nodes where line <= 45)""",
    "fiber_neurons nodes",
)
def orphans(t):
    lost = checks.orphans(t.fiber_neurons, t.nodes.filter("line <= 45"), {"neuron_id": "id"})
    return lost.select("fiber_id", "neuron_id")


@query(
    "ck03_enum_violations",
    "select neuron_id, status from cognitive where status = 'broken'",
    "cognitive",
)
def enum_violations(t):
    return checks.enum_violations(t.cognitive, "status").select("neuron_id", "status")


@query(
    "ck04_null_counts",
    """select 'id' as column_name, count(*) - count(id) as nulls from fibers
        union all select 'created_at', count(*) - count(created_at) from fibers
        union all select 'last_conducted', count(*) - count(last_conducted) from fibers
        union all select 'anchor_neuron_id', count(*) - count(anchor_neuron_id) from fibers""",
    "fibers",
)
def null_counts(t):
    return checks.null_counts(
        t.fibers, ["id", "created_at", "last_conducted", "anchor_neuron_id"]
    )


@query(
    "ck05_fill_defaults",
    """select fiber_id, priority, trust_score is null as no_trust, '[]' as tags, '{{}}' as metadata
        from memories""".replace("{{}}", "{" + "}"),
    "memories",
)
def fill_defaults(t):
    filled = checks.fill_defaults(t.memories, DEFAULTS["typed_memories"])
    return filled.select(
        "fiber_id", "priority", F.col("trust_score").isNull().alias("no_trust"), "tags", "metadata"
    )


# --- change feed ----------------------------------------------------------------------------


@query(
    "sm01_change_feed",
    """select key, value, seq from (
          select key, arg_max(op, seq) as op, arg_max(value, seq) as value, max(seq) as seq
          from changes group by key) x where op <> 'delete'""",
    "changes",
)
def change_feed(t):
    log = _fed_log(t)
    return changes.current_rows(log).select("key", "value", "seq")


@query(
    "sm01_live_edges",
    """with state as (select key, arg_max(op, seq) as op,
            max(seq) filter (op = 'delete') as deleted from changes group by key),
          links as (select concat('u:', cast(user_id as varchar)) as src,
            concat('u:', cast(user_id % 7 as varchar)) as dst, event_id as seq from events)
        select e.seq, e.src, e.dst from links e join state a on e.src = a.key
          join state b on e.dst = b.key
        where a.op <> 'delete' and b.op <> 'delete'
          and coalesce(a.deleted, -1) < e.seq and coalesce(b.deleted, -1) < e.seq""",
    "changes",
)
def live_edges(t):
    edges = t.events.select(
        F.concat(F.lit("u:"), F.col("user_id").cast("string")).alias("src"),
        F.concat(F.lit("u:"), (F.col("user_id") % 7).cast("string")).alias("dst"),
        F.col("event_id").alias("seq"),
    )
    return changes.live_edges(edges, _fed_log(t)).select("seq", "src", "dst")


def _fed_log(t):
    """The events as a feed of several micro-batches, with a fold between and after, and a restart with a new checkpoint."""
    folder = f"{shared_dir(t.spark)}/feed-{uuid.uuid4().hex}"
    events = t.events
    middle = events.select(F.percentile_approx("event_id", 0.5)).head()[0] or 0
    for part, rows in enumerate((events.filter(F.col("event_id") <= middle), events.filter(F.col("event_id") > middle))):
        rows.repartitionByRange(3, "event_id").write.parquet(f"{folder}/in{part}")
        stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in{part}")
        op = (
            F.when(F.col("event_type") == "error", F.lit("delete"))
            .when(F.col("event_type") == "signup", F.lit("add"))
            .otherwise(F.lit("update"))
        )
        feed = stream.select(
            F.col("event_id").alias("seq"),
            F.concat(F.lit("u:"), F.col("user_id").cast("string")).alias("key"),
            op.alias("op"),
            "value",
        )
        changes.apply_changes(feed, f"{folder}/log", f"{folder}/offsets{part}").awaitTermination()
        if part == 0:
            changes.compact(t.spark, f"{folder}/log")
    return changes.current_log(t.spark, f"{folder}/log")
