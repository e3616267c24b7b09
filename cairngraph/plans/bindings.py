"""Graph tables derived from the given tables, as SQL that both engines read.

`{name}` stands for a given table or another binding. Spark fills in frames, the SQL twins get the
same text as a chain of common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cairngraph.operators.common import grown, looked_up
from cairngraph.session import cut, stored

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Tables of one size at every scale.
FIXED_TABLES = ("region", "nation")

BINDINGS = {
    "nodes": """
        select concat('p:', cast(p_partkey as string)) as id,
          cast(p_partkey as string) as symbol_id, p_name as name,
          concat(p_brand, '.', p_name, '.', cast(p_partkey as string)) as qualified_name,
          lower(p_type) as kind, p_brand as file, p_size as line,
          case when p_partkey % 3 = 0 then 'python' when p_partkey % 3 = 1 then 'javascript'
            else 'typescript' end as language,
          concat('/proj/', cast(p_partkey % 5 as string)) as project_path,
          concat('g', cast(p_partkey % 5 as string), '_', cast(p_partkey % 2 as string))
            as generation_id,
          concat(lower(p_type), ': ', p_brand, '.', p_name, '.', cast(p_partkey as string),
            ' in ', p_brand, ':', cast(p_size as string)) as content
        from {part}""",
    "generations": """
        select distinct concat('g', cast(p_partkey % 5 as string), '_',
            cast(p_partkey % 2 as string)) as generation_id,
          concat('/proj/', cast(p_partkey % 5 as string)) as project_path,
          case when p_partkey % 5 = 4 then 'failed' when p_partkey % 2 = 0 then 'active'
            else 'gc' end as status
        from {part}""",
    "edges": """
        select src, dst, edge_type, min(line) as line, max(weight) as weight,
          count(*) as reinforced_count
        from (
          select concat('p:', cast(l_partkey as string)) as src,
            concat('p:', cast(nxt as string)) as dst,
            case l_returnflag when 'N' then 'CALLS' when 'A' then 'IMPORTS' else 'EXTENDS' end
              as edge_type,
            l_linenumber as line, round(l_discount * 10, 2) as weight
          from (select l_partkey, l_returnflag, l_linenumber, l_discount,
                  lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey,
                    l_suppkey, l_returnflag, l_discount, l_quantity) as nxt
                from {lineitem}) x
          where nxt is not null and nxt <> l_partkey) y
        group by src, dst, edge_type""",
    "store_edges": """
        select e.src, e.dst, e.edge_type, e.line, e.weight, e.reinforced_count,
          n.generation_id, n.project_path
        from {edges} e join {nodes} n on e.src = n.id""",
    "call_edges": """
        select src, dst from {edges} where edge_type = 'CALLS'""",
    "fibers": """
        select concat('f:', cast(o_orderkey as string)) as id,
          concat('b:', cast(o_custkey % 10 as string)) as brain_id,
          o_orderdate as created_at, s.last_conducted,
          least(o_totalprice / 500000.0, 1.0) as salience,
          'p:' || cast(s.first_part as string) as anchor_neuron_id
        from {orders} left join (
          select l_orderkey, min(l_shipdate) as last_conducted, min(l_partkey) as first_part
          from {lineitem} group by l_orderkey) s on o_orderkey = l_orderkey""",
    "fiber_neurons": """
        select distinct concat('f:', cast(l_orderkey as string)) as fiber_id,
          concat('b:', cast(o_custkey % 10 as string)) as brain_id,
          concat('p:', cast(l_partkey as string)) as neuron_id
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "brains": """
        select distinct concat('b:', cast(c_custkey % 10 as string)) as id,
          concat('u:', cast(c_custkey % 10 % 3 as string)) as owner_id,
          c_custkey % 10 in (1, 7) as is_public
        from {customer}""",
    "neurons": """
        select concat('p:', cast(p_partkey as string)) as id,
          concat('b:', cast(p_partkey % 10 as string)) as brain_id, p_type as type,
          p_name as content, p_size as access_frequency
        from {part}""",
    # The same ids in two tenants, with other content; edges belong to the tenant of their source.
    "tenant_nodes": """
        select id, brain_id, content, access_frequency from {neurons}
        union all
        select id, concat(brain_id, 'x') as brain_id, concat(content, '*') as content,
          access_frequency + 1 as access_frequency from {neurons} where access_frequency > 10""",
    "tenant_edges": """
        select n.brain_id, e.src, e.dst, e.edge_type, e.weight
        from {edges} e join {tenant_nodes} n on e.src = n.id where e.edge_type = 'CALLS'""",
    "tenant_fibers": """
        select concat('f:', cast(o_orderkey as string)) as id,
          concat('b:', cast(o_orderkey % 10 as string), case when o_orderkey % 2 = 0 then 'x' else '' end)
            as brain_id,
          concat('p:', cast(first_part as string)) as anchor_neuron_id
        from {orders} join (
          select l_orderkey, min(l_partkey) as first_part from {lineitem} group by l_orderkey) s
          on o_orderkey = l_orderkey""",
    "neuron_states": """
        select concat('p:', cast(p_partkey as string)) as neuron_id,
          concat('b:', cast(p_partkey % 10 as string)) as brain_id,
          p_size / 50.0 as activation_level, (p_partkey % 7) / 100.0 as decay_rate,
          s.last_ship as last_activated
        from {part} left join (
          select l_partkey, max(l_shipdate) as last_ship from {lineitem} group by l_partkey) s
          on p_partkey = l_partkey""",
    "memories": """
        select concat('f:', cast(event_id as string)) as fiber_id,
          concat('b:', cast(user_id % 10 as string)) as brain_id, event_type as memory_type,
          cast(floor(value) as int) as priority,
          case when event_id % 6 = 0 then cast(null as timestamp)
            else ts + interval '7' day end as expires_at,
          concat('pr:', cast(user_id % 4 as string)) as project_id,
          case when event_id % 5 = 0 then null else least(value / 100.0, 1.0) end as trust_score
        from {events}""",
    "gaps": """
        select concat('q:', cast(event_id as string)) as id,
          concat('b:', cast(user_id % 10 as string)) as brain_id, event_type as topic,
          case when event_type = 'purchase' then 'done' else null end as resolved_at,
          value as priority
        from {events}""",
    "cognitive": """
        select concat('n:', cast(e.event_id as string)) as neuron_id,
          concat('b:', cast(e.user_id % 10 as string)) as brain_id,
          case e.event_type when 'view' then 'active' when 'click' then 'confirmed'
            when 'signup' then 'pending' when 'error' then 'broken' else null end as status,
          least(e.value / 100.0, 1.0) as confidence,
          coalesce(l.quality, 0) as evidence_for_count, coalesce(l.toxic, 0)
            as evidence_against_count
        from {events} e left join {labels} l on e.event_id = l.doc_id""",
    "snap_local": """
        select concat('c:', cast(c_custkey as string)) as id, c_name as content,
          c_acctbal as weight, 1000 + c_custkey % 97 as updated_at
        from {customer} where c_custkey % 11 <> 0""",
    "snap_incoming": """
        select concat('c:', cast(c_custkey as string)) as id,
          case when c_custkey % 7 = 0 then concat(c_name, '*') else c_name end as content,
          case when c_custkey % 7 = 0 then c_acctbal + 100 else c_acctbal end as weight,
          1000 + (c_custkey * 13) % 97 as updated_at
        from {customer} where c_custkey % 13 <> 0""",
    "changes": """
        select event_id as seq, concat('u:', cast(user_id as string)) as key,
          case when event_type = 'error' then 'delete' when event_type = 'signup' then 'add'
            else 'update' end as op,
          value, ts
        from {events}""",
    "files": """
        select '/repo' as project,
          concat('src', cast(doc_id % 9 as string), '/',
            case doc_id % 11 when 0 then 'node_modules/' when 1 then 'vendor/' else 'lib/' end,
            'd', cast(doc_id as string),
            case doc_id % 8 when 0 then '.py' when 1 then '.TS' when 2 then '.go' when 3 then '.jsx'
              when 4 then '.rs' when 5 then '' when 6 then '.test.js' else '.md' end) as path,
          n_chars * 40 as length, cast(null as string) as content
        from {documents}
        union all
        select '/repo' as project,
          concat('web/', cast(page_id % 20 as string), '/p', cast(page_id as string),
            case when page_id % 3 = 0 then '.tsx' when page_id % 3 = 1 then '.php' else '.js' end)
            as path,
          cast(length(html) as bigint) as length, cast(null as string) as content
        from {pages}""",
    # Loosely typed text columns with dirt in fixed places.
    "dirty": """
        select c_custkey as k,
          case c_custkey % 7 when 0 then 'n/a'
            when 1 then concat(' ', cast(c_nationkey as string), ' ')
            when 2 then '3.7' when 3 then '1_000' when 4 then cast(null as string)
            else cast(c_nationkey as string) end as int_text,
          case c_custkey % 6 when 0 then 'TRUE' when 1 then 'yes' when 2 then '1' when 3 then 'no'
            when 4 then '' else cast(null as string) end as bool_text,
          case c_custkey % 5 when 0 then 'abc' when 1 then '1e3' when 2 then ' 2.5 ' when 3 then ''
            else concat(cast(c_custkey as string), '.25') end as float_text,
          case c_custkey % 5 when 0 then 'yesterday'
            when 1 then concat('2024-01-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'),
              'T10:20:30Z')
            when 2 then concat('2024-02-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'),
              ' 10:20:30.5')
            when 3 then concat('2024-03-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'))
            else '2024' end as ts_text,
          case when c_custkey % 3 = 0 then concat(c_mktsegment, '''s') else c_name end as label,
          case when c_custkey % 4 = 0 then cast(null as int) else c_nationkey % 2 end as synced
        from {customer}""",
    # Source code written from `part`: 20 parts per file, 5 lines per part after 2 import lines.
    "source_lines": """
        select p_partkey as p, cast(floor(p_partkey / 20) as bigint) as n,
          concat('class K', cast(p_partkey as string), '(K', cast(p_partkey - 1 as string),
            ', metaclass=M):\n    def ', replace(p_name, ' ', '_'), '(self, a=',
            cast(p_size as string), '):\n        return self.other(util.run())\ndef f',
            cast(p_partkey as string), '():\n    return K', cast(p_partkey as string), '()\n')
            as snippet
        from {part}""",
    # Facts of a code base: files of up to 500 parts of a brand, references from `edges`.
    "defs": """
        select '/proj' as project, concat('p:', cast(p_partkey as string)) as pid,
          concat('pkg', cast(b % 4 as string), '/m', cast(b as string), 'x',
            cast(cast(floor(p_partkey / 500) as bigint) as string), '.py') as file,
          cast(p_partkey + 1 as int) as ord, name,
          case when p_size % 5 = 0 then name
            when p_size % 5 = 1 then concat('C', cast(p_partkey % 7 as string), '.D')
            when p_size % 3 = 0 then name
            when p_size % 3 = 1 then concat('C', cast(p_partkey % 7 as string), '.', name)
            else concat('C', cast(p_partkey % 7 as string), '.D.', name) end as qualified_name,
          'function' as kind, p_size as line, 'python' as language,
          concat('(a', cast(p_partkey % 3 as string), ')') as signature
        from (select p_partkey, p_size, cast(replace(p_brand, 'Brand#', '') as int) as b,
                case when p_size % 5 = 0 then concat('C', cast(p_partkey % 7 as string))
                  when p_size % 5 = 1 then 'D'
                  else concat(replace(p_name, ' ', '_'), case when p_partkey % 4 = 0
                    then cast(p_partkey as string) else '' end) end as name
              from {part}) x""",
    "code_files": """
        select distinct project, file as path from {defs}""",
    "symbols": """
        select project, file, ord, name, qualified_name, kind, line, language, signature,
          concat(file, '#', cast(ord as string)) as symbol_id
        from {defs}
        union all
        select project, path as file, cast(0 as int) as ord,
          replace(regexp_replace(path, '^.*/', ''), '.py', '') as name,
          path as qualified_name, 'module' as kind, cast(1 as int) as line,
          'python' as language, '' as signature, concat(path, '#0') as symbol_id
        from {code_files}""",
    "refs": """
        select s.project, s.file, s.qualified_name as src_qname,
          case when s.qualified_name = s.name then ''
            else substring(s.qualified_name, 1, length(s.qualified_name) - length(s.name) - 1) end
            as container_text,
          case e.line % 5 when 0 then d.name when 1 then concat('self.', d.name)
            when 2 then d.qualified_name when 3 then concat('this.D.', d.name)
            else concat('C', cast(e.line as string), '.', d.name) end as raw_name,
          e.edge_type, e.line, row_number() over (partition by s.project, s.file, s.pid
            order by e.line, e.dst, e.edge_type) as ord
        from {edges} e join {defs} s on e.src = s.pid join {defs} d on e.dst = d.pid""",
    "py_imports": """
        select s.project, s.file, cast(row_number() over (partition by s.project, s.file
            order by e.line, e.src, e.dst) as int) as ord, e.line,
          case when e.line % 7 = 6 then 'module' else 'from' end as form,
          case e.line % 7 when 0 then 'os' when 1 then concat('.', m.stem)
            when 2 then concat('..', m.dir, '.', m.stem) when 3 then concat('...', m.stem)
            else concat(m.dir, '.', m.stem) end as module_spec,
          case when e.line % 7 = 6 then null else d.name end as imported_name,
          case when e.line % 7 = 6 then m.stem when e.line % 2 = 0 then d.name
            else concat(d.name, '_x') end as binding_name
        from {edges} e join {defs} s on e.src = s.pid join {defs} d on e.dst = d.pid
          join (select path, regexp_replace(path, '/.*$', '') as dir,
              replace(regexp_replace(path, '^.*/', ''), '.py', '') as stem
            from {code_files}) m on d.file = m.path
        where e.edge_type = 'IMPORTS'""",
    # Imports of `py_imports` with their target, from what the spec was made of.
    "resolved": """
        select i.project, i.file, i.ord, i.line, i.form, i.module_spec, i.imported_name,
          i.binding_name, f.path as target_file
        from {py_imports} i left join {code_files} f on f.path =
          case when i.module_spec = 'os' or i.module_spec like '...%' then ''
            when i.module_spec like '..%'
              then concat(replace(substring(i.module_spec, 3, 100), '.', '/'), '.py')
            when i.module_spec like '.%' then concat(regexp_replace(i.file, '/.*$', ''), '/',
              substring(i.module_spec, 2, 100), '.py')
            else concat(replace(i.module_spec, '.', '/'), '.py') end""",
    "bindings": """
        select project, file, binding_name, target_sid from (
          select r.project, r.file, r.binding_name, t.target_sid, row_number() over (
              partition by r.project, r.file, r.binding_name order by r.ord desc) as rn
          from {resolved} r join (
            select file, key, symbol_id as target_sid from (
              select file, name as key, symbol_id, row_number() over (
                partition by file, name order by ord) as rn
              from {symbols} where kind <> 'module') a where rn = 1
            union all
            select file, cast(null as string) as key, symbol_id from {symbols}
            where kind = 'module') t
            on r.target_file = t.file and (r.imported_name = t.key or
              (r.imported_name is null and t.key is null))) z
        where rn = 1""",
    "js_files": """
        select distinct '/proj' as project, concat('web', cast(b % 4 as string), '/m',
            cast(b as string), case b % 5 when 0 then '.ts' when 1 then '.tsx' when 2 then '.js'
              when 3 then '/index.jsx' else '.json' end) as path,
          b, concat('web', cast(b % 4 as string), '/m', cast(b as string)) as base
        from (select cast(floor(p_partkey / 20) as int) as b from {part}) x""",
    "js_imports": """
        select distinct '/proj' as project, concat('web', cast(a.b % 4 as string), '/a',
            cast(a.b as string), '.ts') as file,
          case l_linenumber % 6
            when 0 then concat('./m', cast(t.b as string))
            when 1 then concat('../', t.base) when 2 then concat('../', t.path)
            when 3 then concat('.././web0/../', t.base)
            when 4 then t.base else concat('../../', t.base) end as module_spec,
          case l_linenumber % 6 when 0 then concat('web', cast(a.b % 4 as string), '/m',
              cast(t.b as string)) when 1 then t.base when 2 then t.path when 3 then t.base
            else '' end as wanted
        from {lineitem}
          join (select p_partkey, cast(floor(p_partkey / 20) as int) as b from {part}) x
            on l_partkey = x.p_partkey
          join {js_files} a on x.b = a.b
          join (select p_partkey, cast(floor(p_partkey / 20) as int) as b from {part}) y
            on l_suppkey = y.p_partkey
          join {js_files} t on y.b = t.b""",
    "raw_paths": """
        select doc_id, concat(case when doc_id % 2 = 0 then '/' else '' end,
          'a', cast(doc_id % 5 as string), '/./b/', case when doc_id % 3 = 0 then '../' else '' end,
          source, '//', case when doc_id % 7 = 0 then '../../../..' else lang end, '/') as path
        from {documents}""",
}

# The rows of bindings above, written so that Spark shuffles and sorts less. Edges are grouped by numbers before they get
# names. Targets are joined first, so that what is worked out from a target is one column in the next shuffle. References
# are numbered by `src` before the columns of their source are there; copies of a source share out the numbers. Sorts of
# imports compare the number `place` before files that begin alike.
WRITTEN_FOR_SPARK = {
    "edges": """
        select concat('p:', cast(l_partkey as string)) as src, concat('p:', cast(nxt as string)) as dst,
          edge_type, line, weight, reinforced_count
        from (
          select l_partkey, nxt,
            case l_returnflag when 'N' then 'CALLS' when 'A' then 'IMPORTS' else 'EXTENDS' end
              as edge_type,
            min(l_linenumber) as line, max(round(l_discount * 10, 2)) as weight,
            count(*) as reinforced_count
          from (select l_partkey, l_returnflag, l_linenumber, l_discount,
                  lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey,
                    l_suppkey, l_returnflag, l_discount, l_quantity) as nxt
                from {lineitem}) x
          where nxt is not null and nxt <> l_partkey
          group by 1, 2, 3) y""",
    "refs": """
        select s.project, s.file, s.qualified_name as src_qname,
          case when s.qualified_name = s.name then ''
            else substring(s.qualified_name, 1, length(s.qualified_name) - length(s.name) - 1) end
            as container_text,
          n.raw_name, n.edge_type, n.line, cast((n.at - 1) * s.copies + s.copy as int) as ord
        from (
          select src, edge_type, line, raw_name,
            row_number() over (partition by src order by line, dst, edge_type) as at
          from (
            select e.src, e.dst, e.edge_type, e.line,
              case e.line % 5 when 0 then d.name when 1 then concat('self.', d.name)
                when 2 then d.qualified_name when 3 then concat('this.D.', d.name)
                else concat('C', cast(e.line as string), '.', d.name) end as raw_name
            from {edges} e join {defs} d on e.dst = d.pid) t) n
          join (
            select *, count(*) over (partition by pid, file, project) as copies,
              row_number() over (partition by pid, file, project order by name) as copy
            from {defs}) s on n.src = s.pid""",
    "py_imports": """
        select project, file, cast(row_number() over (partition by place, project, file
            order by line, src, dst) as int) as ord, line, form, module_spec, imported_name, binding_name
        from (
          select s.project, s.file, xxhash64(s.project, s.file) as place, t.src, t.dst, t.line,
            t.form, t.module_spec, t.imported_name, t.binding_name
          from (
            select e.src, e.dst, e.line,
              case when e.line % 7 = 6 then 'module' else 'from' end as form,
              case e.line % 7 when 0 then 'os' when 1 then concat('.', d.stem)
                when 2 then concat('..', d.dir, '.', d.stem) when 3 then concat('...', d.stem)
                else concat(d.dir, '.', d.stem) end as module_spec,
              case when e.line % 7 = 6 then null else d.name end as imported_name,
              case when e.line % 7 = 6 then d.stem when e.line % 2 = 0 then d.name
                else concat(d.name, '_x') end as binding_name
            from {edges} e join (
              select pid, name, regexp_replace(file, '/.*$', '') as dir,
                replace(regexp_replace(file, '^.*/', ''), '.py', '') as stem
              from {defs} where file is not null) d on e.dst = d.pid
            where e.edge_type = 'IMPORTS') t
            join {defs} s on t.src = s.pid) x""",
}

# Bindings with one row for each key they are joined by.
LOOKED_UP = ("defs",)

_NAME = re.compile(r"\{(\w+)\}")


def _closure(names: list[str], seen: dict[str, None]) -> dict[str, None]:
    for name in names:
        if name in BINDINGS and name not in seen:
            _closure(_NAME.findall(BINDINGS[name]), seen)
            seen[name] = None
    return seen


def oracle_text(sql: str, uses: list[str]) -> str:
    """The twin's SQL with the bindings it needs in front."""
    needed = _closure(uses, {})
    ctes = [f"{name} as ({_NAME.sub(r'\1', BINDINGS[name])})" for name in needed]
    body = _NAME.sub(r"\1", sql).strip()
    if body.lower().startswith("with recursive"):
        head, rest = "with recursive ", body[len("with recursive") :].strip()
        return f"{head}{', '.join([*ctes, rest])}"
    if body.lower().startswith("with "):
        return f"with {', '.join([*ctes, body[5:].strip()])}"
    return f"with {', '.join(ctes)} {body}" if ctes else body


class Tables:
    """Given tables and bindings of one data folder as frames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in BINDINGS:
            return self.sql(WRITTEN_FOR_SPARK.get(name, BINDINGS[name]))
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        names = set(_NAME.findall(text))
        frames = {name: getattr(self, name) for name in names}
        if " join " in text.lower():
            # A hint to sort would win over one to hash.
            hashed = names.intersection(LOOKED_UP)
            hints = {name: looked_up if name in hashed else None if hashed or name in FIXED_TABLES else grown for name in names}
            frames = {name: hints[name](frame) if hints[name] else frame for name, frame in frames.items()}
        return self.spark.sql(text, **frames)

    def stored(self, name: str) -> DataFrame:
        """A binding written once, for jobs that scan it repeatedly."""
        return cut(getattr(self, name))

    def keep(self, *names: str) -> None:
        """Write bindings once as Parquet: what reads them from now on, other bindings too, reads the columns it asks for."""
        for name in names:
            setattr(self, name, stored(getattr(self, name)))
