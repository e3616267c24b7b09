"""Queries of fact extraction and name resolution.

Source text is written from `part` (see the binding `source_lines`), so every expected fact follows
from a part's key; the facts of a larger code base come from `part` and `edges`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairngraph.operators import facts, resolve
from cairngraph.plans.index_job import index_project, index_projects
from cairngraph.plans.registry import query
from cairngraph.session import compact, cut, stored


def source_files(t, broken: bool = False):
    """One Python file per 20 parts; with `broken` each file whose number ends in 3 cannot be read."""
    header = F.lit("import os, m0.sub as zero\nfrom util import run as r, walk\n")
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("p", "snippet"))), lambda s: s["snippet"]),
        "",
    )
    written = t.source_lines.groupBy("n").agg(F.concat(header, body).alias("content"))
    if broken:
        tail = F.when(F.col("n") % 10 == 3, F.lit("def :\n")).otherwise(F.lit(""))
        written = written.withColumn("content", F.concat("content", tail))
    return written.select(
        F.lit("/proj").alias("project"),
        F.concat(F.lit("m"), F.col("n").cast("string"), F.lit(".py")).alias("path"),
        F.length("content").cast("bigint").alias("length"),
        "content",
    )


def source_facts(t):
    # The written files are few bytes and much parsing.
    return facts.facts_table(source_files(t), t.spark.sparkContext.defaultParallelism)


FILE = "concat('m', cast(n as varchar), '.py')"
FIRST_LINE = "3 + 5 * (p % 20)"


@query(
    "cf01_definitions",
    f"""select {FILE} as file, concat('K', cast(p as varchar)) as qualified_name, 'class' as kind,
          cast({FIRST_LINE} as integer) as line, '' as signature from source_lines
        union all
        select {FILE}, concat('K', cast(p as varchar), '.', replace(p_name, ' ', '_')), 'method',
          cast({FIRST_LINE} + 1 as integer), concat('(self, a=', cast(p_size as varchar), ')')
        from source_lines join part on p = p_partkey
        union all
        select {FILE}, concat('f', cast(p as varchar)), 'function',
          cast({FIRST_LINE} + 3 as integer), '()' from source_lines""",
    "source_lines",
)
def definitions(t):
    defs, *_ = facts.split_facts(source_facts(t))
    return defs.select("file", "qualified_name", "kind", "line", "signature")


@query(
    "cf02_imports",
    f"""select distinct {FILE} as file, i.ord, i.line, i.form, i.module_spec, i.imported_name,
          i.binding_name
        from source_lines, (values (cast(0 as integer), cast(1 as integer), 'module', 'os', null,
            'os'), (1, 1, 'module', 'm0.sub', null, 'zero'), (2, 2, 'from', 'util', 'run', 'r'),
            (3, 2, 'from', 'util', 'walk', 'walk'))
          i(ord, line, form, module_spec, imported_name, binding_name)""",
    "source_lines",
)
def imports(t):
    _, found, *_ = facts.split_facts(source_facts(t))
    return found.drop("project")


@query(
    "cf03_calls",
    f"""select {FILE} as file, concat('K', cast(p as varchar), '.', replace(p_name, ' ', '_'))
          as src_qname, concat('K', cast(p as varchar)) as containers, raw_name,
          cast({FIRST_LINE} + 2 as integer) as line
        from source_lines join part on p = p_partkey,
          (values ('self.other'), ('util.run')) r(raw_name)
        union all
        select {FILE}, concat('f', cast(p as varchar)), '', concat('K', cast(p as varchar)),
          cast({FIRST_LINE} + 4 as integer) from source_lines""",
    "source_lines",
)
def calls(t):
    found = facts.split_facts(source_facts(t))[3]
    return found.select(
        "file", "src_qname", F.array_join("containers", ".").alias("containers"), "raw_name", "line"
    )


@query(
    "cf04_bases",
    f"""select {FILE} as file, concat('K', cast(p as varchar)) as class_qname,
          concat('K', cast(p - 1 as varchar)) as base_name, 'EXTENDS' as relation,
          cast({FIRST_LINE} as integer) as line from source_lines where p > 0
        """,
    "source_lines",
)
def bases(t):
    found = facts.split_facts(source_facts(t))[2]
    return found.select("file", "class_qname", "base_name", "relation", "line")


@query(
    "cf05_module_symbols",
    """select path as qualified_name, regexp_replace(regexp_extract(path, '([^/]*)$', 1),
            '[.][^.]+$', '') as name,
          case when lower(path) like '%.py' then 'python' when lower(path) like '%.js'
            or lower(path) like '%.jsx' then 'javascript' else 'typescript' end as language,
          sha256(concat('/repo:', case when lower(path) like '%.py' then 'python'
            when lower(path) like '%.js' or lower(path) like '%.jsx' then 'javascript'
            else 'typescript' end, ':', path, ':', path, ':')) as symbol_id
        from files where regexp_matches(lower(path), '[.](py|js|jsx|ts|tsx)$')""",
    "files",
)
def module_symbols(t):
    found = resolve.module_symbols(t.files)
    return found.select("qualified_name", "name", "language", "symbol_id")





@query(
    "cf06_python_modules",
    """select file, ord, module_spec, target_file from resolved""",
    "resolved",
)
def python_modules(t):
    found = resolve.resolve_python_modules(t.stored("py_imports"), t.code_files)
    return found.select("file", "ord", "module_spec", "target_file")


@query(
    "cf07_js_modules",
    """select i.file, i.module_spec, f.path as target_file from js_imports i left join js_files f
          on i.wanted <> '' and f.path not like '%.json'
          and (f.path = i.wanted or (f.base = i.wanted))""",
    "js_imports js_files",
)
def js_modules(t):
    found = resolve.resolve_js_modules(t.stored("js_imports"), t.js_files)
    return found.select("file", "module_spec", "target_file")



@query(
    "cf08_import_edges",
    """select r.file, concat(r.file, '#0') as source_sid, concat(r.target_file, '#0') as target_sid,
          'IMPORTS' as type, min(r.ord) as ord, arg_min(r.line, r.ord) as line
        from resolved r where r.target_file is not null group by r.file, r.target_file""",
    "resolved",
)
def import_edges(t):
    resolved = resolve.resolve_python_modules(t.stored("py_imports"), t.code_files)
    modules = t.symbols.filter("kind = 'module'")
    return resolve.import_edges(resolved, modules).drop("project")


@query("cf09_import_bindings", "select file, binding_name, target_sid from bindings", "bindings")
def import_bindings(t):
    resolved = resolve.resolve_python_modules(t.stored("py_imports"), t.code_files)
    return resolve.import_bindings(resolved, t.symbols).drop("project")


LAST_QUALIFIED = """
    (select file, qualified_name, arg_max(symbol_id, ord) as sid from symbols
     group by file, qualified_name)"""


@query(
    "cf10_contains_edges",
    f"""select s.file, concat(s.file, '#0') as source_sid, s.symbol_id as target_sid, s.ord, s.line
        from symbols s where s.kind <> 'module' and not contains(s.qualified_name, '.')
        union all
        select s.file, q.sid, s.symbol_id, s.ord, s.line
        from symbols s join {LAST_QUALIFIED} q on s.file = q.file
          and q.qualified_name = regexp_replace(s.qualified_name, '[.][^.]*$', '')
        where s.kind <> 'module' and contains(s.qualified_name, '.')""",
    "symbols",
)
def contains_edges(t):
    return resolve.contains_edges(t.symbols).drop("project", "type")


CASCADE = f"""
    lookup_q as {LAST_QUALIFIED},
    lookup_s as (
      select file, name, case when count(*) = 1 then min(symbol_id)
          when count(*) filter (not contains(qualified_name, '.')) = 1
          then min(symbol_id) filter (not contains(qualified_name, '.')) end as sid,
        case when count(*) = 1 then 6 else 7 end as rule
      from symbols group by file, name),
    once as (
      select distinct file, container_text as c, raw_name,
        case when container_text <> '' then split_part(container_text, '.', 1) end as outer_name,
        container_text <> '' and (raw_name like 'self.%' or raw_name like 'this.%') as own
      from refs),
    short as (
      select *, case when own then substring(raw_name, 6, 1000) else raw_name end as rest from once),
    hit as (
      select o.file, o.c, o.raw_name,
        coalesce(b.target_sid, q2.sid, q3.sid, q4.sid, q5.sid, s.sid) as target_sid,
        cast(case when b.target_sid is not null then 1 when q2.sid is not null then 2
          when q3.sid is not null then 3 when q4.sid is not null then 4
          when q5.sid is not null then 5 when s.sid is not null then s.rule end as integer) as rule
      from short o
        left join bindings b on b.file = o.file and b.binding_name = o.raw_name
        left join lookup_q q2 on o.own and q2.file = o.file
          and q2.qualified_name = concat(o.outer_name, '.', o.rest)
        left join lookup_q q3 on q3.file = o.file and q3.qualified_name = o.rest
        left join lookup_q q4 on o.c <> '' and q4.file = o.file
          and q4.qualified_name = concat(o.c, '.', o.rest)
        left join lookup_q q5 on o.c <> '' and q5.file = o.file
          and q5.qualified_name = concat(o.outer_name, '.', o.rest)
        left join lookup_s s on s.file = o.file and s.name = o.rest)"""


def _references(t, *types: str):
    """The references; with `types` those of other edges are left out and `ord` does not count them."""
    text = F.col("container_text")
    containers = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\."))
    edges = t.edges.filter(F.col("edge_type").isin(*types)) if types else t.edges
    t.edges = edges.select("src", "dst", "edge_type", "line")
    # References and imports come from the same definitions and edges.
    t.keep("defs", "edges")
    return t.refs.withColumns({"containers": containers, "type": F.col("edge_type")}).drop(
        "container_text", "edge_type"
    )


def _bindings(t):
    t.keep("py_imports")
    resolved = resolve.resolve_python_modules(t.py_imports, t.code_files)
    return resolve.import_bindings(resolved, t.symbols)


@query(
    "cf13_name_resolution",
    f"with {CASCADE.strip()} select file, c as containers, raw_name, target_sid, rule from hit",
    "symbols refs bindings",
)
def name_resolution(t):
    refs = _references(t).select(*resolve.NAME).distinct()
    found = resolve.resolve_names(refs, t.symbols, _bindings(t))
    return found.select(
        "file", F.array_join("containers", ".").alias("containers"), "raw_name", "target_sid", "rule"
    )


EDGES_OF_REFS = f"""
    with {CASCADE.strip()},
    found as (
      select r.file, r.edge_type, q.sid as source_sid, h.target_sid, r.ord, r.line
      from refs r
        join hit h on h.file = r.file and h.c = r.container_text and h.raw_name = r.raw_name
        join lookup_q q on q.file = r.file and q.qualified_name = r.src_qname
      where h.target_sid is not null)"""


@query(
    "cf11_inheritance_edges",
    f"""{EDGES_OF_REFS} select distinct file, source_sid, target_sid, 'EXTENDS' as type
        from found where edge_type = 'EXTENDS'""",
    "symbols refs bindings",
)
def inheritance_edges(t):
    # Which reference is an edge's first is not asked for: calls need not be there to be counted.
    refs = _references(t, "EXTENDS", "IMPORTS").filter("type = 'EXTENDS'")
    bases = refs.withColumnsRenamed(
        {"src_qname": "class_qname", "raw_name": "base_name", "type": "relation"}
    )
    found = resolve.inheritance_edges(bases, t.symbols, _bindings(t))
    return found.select("file", "source_sid", "target_sid", "type")


@query(
    "cf12_call_edges",
    f"""{EDGES_OF_REFS} select file, source_sid, target_sid, 'CALLS' as type,
          arg_min(line, struct_pack(o := ord, l := line)) as line
        from found where edge_type = 'CALLS' and source_sid <> target_sid
        group by file, source_sid, target_sid""",
    "symbols refs bindings",
)
def call_edges(t):
    refs = stored(_references(t).filter("type = 'CALLS'"))
    found = resolve.call_edges(refs, t.symbols, _bindings(t))
    return found.select("file", "source_sid", "target_sid", "type", "line")


@query(
    "cf14_dedupe_edges",
    """select src as source_sid, edge_type as type, dst as target_sid, min(line) as line
        from edges group by src, dst, edge_type""",
    "edges",
)
def dedupe_edges(t):
    once = t.stored("edges").select(
        F.lit("/proj").alias("project"), F.lit("f").alias("file"), F.col("src").alias("source_sid"),
        F.col("dst").alias("target_sid"), F.col("edge_type").alias("type"), "line",
        F.col("line").alias("ord"),
    )
    later = once.withColumns({"line": F.col("line") + 100, "ord": F.col("ord") + 100})
    kept = resolve.dedupe_edges(later.unionByName(once))
    return kept.select("source_sid", "type", "target_sid", "line")


@query(
    "cf15_fault_isolation",
    f"""select {FILE} as file, count(*) as parts from source_lines where n % 10 <> 3 group by n""",
    "source_lines",
)
def fault_isolation(t):
    files = source_files(t, broken=True)
    defs, _, _, _, errors = facts.extract_facts(files)
    healthy = facts.healthy_files(files, errors).select(F.col("path").alias("file"))
    classes = defs.filter("kind = 'class'").groupBy("file").agg(F.count(F.lit(1)).alias("parts"))
    return healthy.join(classes, "file", "left")


@query(
    "dm09_index_project",
    """select 'success' as status, f.n as files_scanned, f.healthy + 3 * p.n as symbols,
          3 * p.n + p.n + p.inner_bases as edges, f.n - f.healthy as skipped
        from (select count(distinct n) as n, count(distinct n) filter (n % 10 <> 3) as healthy
              from source_lines) f,
          (select count(*) as n, count(*) filter (p % 20 <> 0) as inner_bases
           from source_lines where n % 10 <> 3) p""",
    "source_lines",
)
def index_run(t):
    files = cut(source_files(t, broken=True))
    _, report = index_project(t.spark, files, now="2026-01-01T00:00:00+00:00")
    return report.select("status", "files_scanned", "symbols", "edges", "skipped")


# Files of five projects; those whose number ends in 3 are broken, and of project 3 all of them.
SEVERAL = """
    parts as (select p, n, n % 5 as j, n % 10 = 3 or n % 5 = 3 as broken from source_lines),
    per as (select j, count(distinct n) as files, count(distinct n) filter (not broken) as healthy,
        count(*) filter (not broken) as n, count(*) filter (not broken and p % 20 <> 0) as inner_bases
      from parts group by j)"""


def several_projects(t):
    files = source_files(t)
    n = F.regexp_extract("path", "[0-9]+", 0).cast("bigint")
    broken = (n % 10 == 3) | (n % 5 == 3)
    # written relative, with a detour
    project = F.concat(F.lit("code/x/../"), (n % 5).cast("string"))
    return files.withColumns({"project": project, "content": F.concat("content", F.when(broken, F.lit("def :\n")).otherwise(F.lit("")))})


@query(
    "dm09_index_projects",
    f"""with {SEVERAL.strip()}
        select '/code/' || cast(j as varchar) as project, case when healthy > 0 then 'success' else 'error' end as status,
          files as files_scanned, case when healthy > 0 then healthy + 3 * n else 0 end as symbols,
          case when healthy > 0 then 3 * n + n + inner_bases else 0 end as edges, files - healthy as skipped
        from per""",
    "source_lines",
)
def index_runs(t):
    _, report = index_projects(t.spark, cut(several_projects(t)), now="2026-01-01T00:00:00+00:00")
    return report.select("project", "status", "files_scanned", "symbols", "edges", "skipped")


@query(
    "dm04_settled_generations",
    f"""with {SEVERAL.strip()}
        select '/code/' || cast(j as varchar) as project_path, run, case when healthy = 0 then 'failed'
            when run = 1 then 'gc' when j = 1 then 'failed' else 'active' end as status,
          case when healthy = 0 or (run = 2 and j = 1) then 0 else healthy + 3 * n end as symbol_count,
          healthy = 0 or (run = 2 and j = 1) as has_error
        from per, (values (1), (2)) r(run) where not (run = 1 and j = 1)
        union all
        select '/code/1', 1, 'active', healthy + 3 * n, false from per where j = 1""",
    "source_lines",
)
def settled_generations(t):
    """Two runs over five projects. The second loses a row of project 1 while writing, so this one keeps its first generation."""
    files = compact(several_projects(t))
    first, _ = index_projects(t.spark, files, now="1")

    def lossy(name, rows):
        rows = compact(rows)
        if name != "nodes":
            return rows
        lost = rows.filter("project_path = '/code/1'").agg(F.min("id")).head()[0]
        return rows.filter(F.col("id") != lost) if lost else rows

    second, _ = index_projects(t.spark, files, first, now="2", write=lossy)
    return second["generations"].select(
        "project_path", F.col("created_at").cast("int").alias("run"), "status", "symbol_count", F.col("error").isNotNull().alias("has_error")
    )


@query(
    "dm09_stored_nodes",
    f"""with {SEVERAL.strip()}
        select '/code/' || cast(j as varchar) as project_path, kind, count(*) as n from (
          select j, n, unnest(['class', 'function', 'method']) as kind from parts where not broken
          union all
          select j, n, 'module' from (select distinct j, n from parts where not broken) x) y
        group by j, kind""",
    "source_lines",
)
def stored_nodes(t):
    tables, _ = index_projects(t.spark, cut(several_projects(t)), now="1")
    return tables["nodes"].groupBy("project_path", "kind").agg(F.count(F.lit(1)).alias("n"))
