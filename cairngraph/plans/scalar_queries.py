"""Queries of the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairngraph.functions import scalars as S
from cairngraph.plans.registry import query
from cairngraph.plans.source_queries import BOOL_VALUE, EXT, FLOAT_VALUE, INT_VALUE



@query(
    "sc01_symbol_id",
    """select id, sha256(concat(project_path, ':', language, ':', file, ':', qualified_name, ':'))
          as symbol_id from nodes""",
    "nodes",
)
def symbol_id(t):
    sid = S.symbol_id("project_path", "language", "file", "qualified_name", F.lit(""))
    return t.nodes.select("id", sid.alias("symbol_id"))


@query(
    "sc02_generation_id",
    """select o_orderkey, substring(sha256(concat(cast(o_orderkey as varchar), ':',
          strftime(o_orderdate, '%Y-%m-%d'))), 1, 16) as generation_id from orders""",
)
def generation_id(t):
    gid = S.generation_id("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", gid.alias("generation_id"))


@query(
    "sc03_edge_id",
    """select src, dst, edge_type,
          sha256(concat(generation_id, ':', src, ':', edge_type, ':', dst)) as edge_id
        from store_edges""",
    "store_edges",
)
def edge_id(t):
    eid = S.edge_id("generation_id", "src", "edge_type", "dst")
    return t.store_edges.select("src", "dst", "edge_type", eid.alias("edge_id"))


@query(
    "sc04_node_id",
    "select id, concat(generation_id, ':', symbol_id) as node_id from nodes",
    "nodes",
)
def node_id(t):
    return t.nodes.select("id", S.node_id("generation_id", "symbol_id").alias("node_id"))


@query(
    "sc05_content_text",
    """select id, concat(kind, ': ', qualified_name, ' in ', file, ':', cast(line as varchar))
          as content from nodes""",
    "nodes",
)
def content_text(t):
    text = S.content_text("kind", "qualified_name", "file", "line")
    return t.nodes.select("id", text.alias("content"))


@query(
    "sc06_matches_query",
    """select doc_id, contains(lower(text), 'the') or contains(lower(source), 'the')
          or contains(lower(lang), 'the') as hit from documents""",
)
def matches_query(t):
    return t.documents.select("doc_id", S.matches_query("THE", "text", "source", "lang").alias("hit"))


@query(
    "sc07_normalize_path",
    """select doc_id, concat(case when doc_id % 2 = 0 then '' else '/home/u' end,
            '/a', cast(doc_id % 5 as varchar),
            case when doc_id % 3 = 0 then '' else '/b' end, '/', source, '/', lang) as path
        from raw_paths join documents using (doc_id)
        where doc_id % 7 <> 0
        union all
        select doc_id, case when doc_id % 2 = 1 and doc_id % 3 <> 0 then '/home' else '/' end
        from raw_paths where doc_id % 7 = 0""",
    "raw_paths",
)
def normalize_path(t):
    return t.raw_paths.select("doc_id", S.normalize_path("path", "/home/u").alias("path"))


@query(
    "sc08_language",
    f"""select path, case {EXT} when '.js' then 'javascript' when '.jsx' then 'javascript'
          when '.ts' then 'typescript' when '.tsx' then 'typescript' when '.py' then 'python'
          when '.go' then 'go' when '.rs' then 'rust' when '.php' then 'php' end as language,
          case when {EXT} in ('.js', '.jsx', '.ts', '.tsx', '.py') then 'supported'
          when {EXT} in ('.go', '.rs', '.php') then 'planned_v2' else 'unsupported' end as support
        from files""",
    "files",
)
def language(t):
    ext = S.extension_of("path")
    return t.files.select(
        "path", S.language_of(ext).alias("language"), S.support_of(ext).alias("support")
    )


AGE = "(epoch_us(timestamp '1998-06-01') - epoch_us(last_conducted)) / 3600000000.0"


@query(
    "sc09_recency_factor",
    f"""select id, round(case when last_conducted is null then 0.3 + 0.4 * salience
          else greatest(0.1, 1.0 / (1.0 + exp(greatest(-100.0, least(100.0,
            ({AGE} - 72) / 36))))) end, 6) as factor
        from fibers""",
    "fibers",
)
def recency_factor(t):
    factor = S.recency_factor("last_conducted", "salience", F.lit("1998-06-01").cast("timestamp"))
    return t.fibers.select("id", F.round(factor, 6).alias("factor"))


@query(
    "sc10_age_report",
    f"""select id, round({AGE}, 4) as age_hours, round(({AGE} - 72) / 36, 4) as z
        from fibers where last_conducted is not null""",
    "fibers",
)
def age_report(t):
    ref = F.lit("1998-06-01").cast("timestamp")
    used = t.fibers.filter(F.col("last_conducted").isNotNull())
    return used.select(
        "id",
        F.round(S.age_hours("last_conducted", ref), 4).alias("age_hours"),
        F.round(S.age_z("last_conducted", ref), 4).alias("z"),
    )


@query(
    "sc11_to_bool",
    f"select k, {BOOL_VALUE} as from_text, synced <> 0 as from_number from dirty",
    "dirty",
)
def to_bool(t):
    return t.dirty.select(
        "k",
        S.to_bool("bool_text").alias("from_text"),
        S.to_bool("synced", "number").alias("from_number"),
    )


@query(
    "sc12_to_int",
    f"""select d.k, {INT_VALUE} as from_text, cast(trunc(c_acctbal) as bigint) as from_number
        from dirty d join customer on k = c_custkey""",
    "dirty",
)
def to_int(t):
    joined = t.dirty.join(t.customer, F.col("k") == F.col("c_custkey"))
    return joined.select(
        "k",
        S.to_int("int_text").alias("from_text"),
        S.to_int("c_acctbal", "number").alias("from_number"),
    )


@query("sc13_to_float", f"select k, {FLOAT_VALUE} as value from dirty", "dirty")
def to_float(t):
    return t.dirty.select("k", S.to_float("float_text").alias("value"))


@query(
    "sc14_to_timestamp",
    """select k, case when k % 5 = 0 or k % 5 = 4 then null
          when k % 5 = 3 then replace(substring(ts_text, 1, 10), 'T', ' ') || ' 00:00:00.0'
          when k % 5 = 2 then ts_text
          else replace(substring(ts_text, 1, 19), 'T', ' ') || '.0' end as from_text,
          strftime(timestamp '1970-01-01' + to_seconds(k * 1000), '%Y-%m-%d %H:%M:%S')
            as from_number
        from dirty""",
    "dirty",
)
def to_timestamp(t):
    return t.dirty.select(
        "k",
        F.date_format(S.to_ts("ts_text"), "yyyy-MM-dd HH:mm:ss.S").alias("from_text"),
        F.date_format(S.to_ts(F.col("k") * 1000, "number"), "yyyy-MM-dd HH:mm:ss").alias("from_number"),
    )


@query(
    "sc15_bytes_to_text",
    """select doc_id, case when doc_id % 2 = 0 then concat(source, lang)
          else lower(concat('ff', hex(encode(concat(source, lang))))) end as value from documents""",
)
def bytes_to_text(t):
    raw = F.concat("source", "lang").cast("binary")
    broken = F.concat(F.unhex(F.lit("FF")), raw)
    value = F.when(F.col("doc_id") % 2 == 0, raw).otherwise(broken)
    return t.documents.select("doc_id", S.bytes_to_text(value).alias("value"))


@query(
    "sc16_repair_reason",
    """select id, case when year(last_conducted) < 1998 then 'pre2026'
            when last_conducted < created_at then 'before-created' end as for_all,
          case when year(last_conducted) < 1998 then 'pre2026' end as for_year,
          case when last_conducted < created_at then 'before-created' end as for_order
        from fibers""",
    "fibers",
)
def repair_reason(t):
    reasons = {"for_all": "all", "for_year": "pre2026", "for_order": "before-created"}
    return t.fibers.select(
        "id",
        *[
            S.repair_reason("created_at", "last_conducted", policy, 1998).alias(name)
            for name, policy in reasons.items()
        ],
    )


@query(
    "sc17_normalize_last",
    """select id, strftime(case when year(last_conducted) < 1998 or last_conducted < created_at
          then created_at else last_conducted end, '%Y-%m-%d') as last_conducted from fibers""",
    "fibers",
)
def normalize_last(t):
    fixed = S.normalize_last("created_at", "last_conducted", 1998)
    return t.fibers.select("id", F.date_format(fixed, "yyyy-MM-dd").alias("last_conducted"))


@query(
    "sc18_utc_iso",
    "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as ts from events",
)
def utc_iso(t):
    return t.events.select("event_id", S.utc_iso("ts").alias("ts"))


@query(
    "sc19_risk",
    """select dst, count(*) as callers, case when count(*) >= 20 then 'high'
          when count(*) >= 5 then 'medium' else 'low' end as risk
        from edges where edge_type = 'CALLS' group by dst""",
    "edges",
)
def risk(t):
    calls = t.edges.filter("edge_type = 'CALLS'").groupBy("dst")
    return calls.agg(F.count(F.lit(1)).alias("callers")).withColumn("risk", S.risk("callers"))


@query(
    "sc20_metadata_get",
    """select event_id, json_extract_string(props, '$.k') as k,
          event_type = 'click' or event_type = 'view' as tagged from events""",
)
def metadata_get(t):
    tags = F.when(F.col("event_type").isin("click", "view"), F.array(F.lit("seen"), "event_type"))
    meta = F.to_json(F.struct(tags.alias("tags")))
    return t.events.select(
        "event_id", S.meta_get("props", "k").alias("k"), S.meta_has_tag(meta, "seen").alias("tagged")
    )


@query(
    "sc21_metadata_patch",
    """select event_id, json_extract_string(props, '$.k') as k, event_type as status,
          '0' as edge_count from events""",
)
def metadata_patch(t):
    patched = S.meta_patch("props", status=F.col("event_type"), edge_count=0)
    return t.events.withColumn("meta", patched).select(
        "event_id",
        *[S.meta_get("meta", key).alias(key) for key in ("k", "status", "edge_count")],
    )
