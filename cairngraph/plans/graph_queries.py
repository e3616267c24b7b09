"""Queries of the join and traversal operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairngraph.operators import graph
from cairngraph.operators.rollup import affected_files
from cairngraph.plans.registry import query
from cairngraph.plans.search_queries import ACTIVE
from cairngraph.session import stored


def calls(t):
    """All call edges with the columns the operators read, written once in the order of the called."""
    return stored(t.call_edges.withColumn("edge_type", F.lit("CALLS")), "dst", "src")


@query(
    "gr01_neighbors",
    """select e.src as node_id, n.id, e.edge_type, e.weight, 'out' as direction
        from edges e join nodes n on e.dst = n.id where e.weight >= 0.3
        union all
        select e.dst, n.id, e.edge_type, e.weight, 'in'
        from edges e join nodes n on e.src = n.id where e.weight >= 0.3""",
    "nodes edges",
)
def neighbors(t):
    found = graph.neighbors(t.nodes, t.edges, min_weight=0.3)
    return found.select("node_id", "id", "edge_type", "weight", "direction")


@query(
    "gr01_neighbors_by_tenant",
    """select e.brain_id, e.src as node_id, n.id, n.content, e.weight, 'out' as direction
        from tenant_edges e join tenant_nodes n on e.dst = n.id and e.brain_id = n.brain_id
        union all
        select e.brain_id, e.dst, n.id, n.content, e.weight, 'in'
        from tenant_edges e join tenant_nodes n on e.src = n.id and e.brain_id = n.brain_id""",
    "tenant_nodes tenant_edges",
)
def neighbors_by_tenant(t):
    found = graph.neighbors(t.tenant_nodes, t.tenant_edges)
    return found.select("brain_id", "node_id", "id", "content", "weight", "direction")


def _linked_sql(here: str, there: str) -> str:
    return f"""
        select distinct n.id, n.qualified_name, n.file, n.line
        from edges e join nodes n on e.{there} = n.id
          join nodes s on e.{here} = s.id
        where e.edge_type = 'CALLS' and s.symbol_id = '6' and s.{ACTIVE}
          and n.project_path = '/proj/1' and s.project_path = '/proj/1'
        order by n.qualified_name, n.file, n.line, n.id limit 20"""


@query("gr02_callers", _linked_sql("dst", "src"), "nodes edges generations")
def callers(t):
    found = graph.callers(t.nodes, t.edges, t.generations, "6", "/proj/1")
    return found.select("id", "qualified_name", "file", "line")


@query("gr03_callees", _linked_sql("src", "dst"), "nodes edges generations")
def callees(t):
    found = graph.callees(t.nodes, t.edges, t.generations, "6", "/proj/1")
    return found.select("id", "qualified_name", "file", "line")


REACHED = """
    with recursive r(n, depth) as (
      select 'p:6', 0
      union
      select e.src, r.depth + 1 from r join call_edges e on e.dst = r.n where r.depth < 3)"""


@query(
    "gr04_impact",
    f"""{REACHED}
        select n as id, min(depth) as depth, qualified_name, file from r join nodes on n = nodes.id
        where n <> 'p:6' group by n, qualified_name, file""",
    "call_edges nodes",
)
def impact(t):
    found, _ = graph.impact(t.nodes, calls(t), t.generations, "6")
    return found.select("id", "depth", "qualified_name", "file")


def _capped_level(number: int, before: str, seen: str, used: str) -> str:
    return f"""
        all{number} as (
          select distinct e.src as id from call_edges e where e.dst in ({before})
            and e.src not in ({seen})),
        kept{number} as (
          select id from (select a.id, row_number() over (order by qualified_name, file, line,
              symbol_id, a.id) as rn from all{number} a join nodes on a.id = nodes.id) x
          where rn <= 3 - ({used}))"""


CAPPED = ",".join(
    [
        _capped_level(1, "select 'p:6'", "select 'p:6'", "0"),
        _capped_level(
            2,
            "select id from kept1",
            "select 'p:6' union all select id from all1",
            "select count(*) from kept1",
        ),
        _capped_level(
            3,
            "select id from kept2",
            "select 'p:6' union all select id from all1 union all select id from all2",
            "(select count(*) from kept1) + (select count(*) from kept2)",
        ),
    ]
)


@query(
    "gr04_impact_capped",
    f"""with {CAPPED.strip()},
          found as (select id, 1 as depth from kept1 union all select id, 2 from kept2
            union all select id, 3 from kept3),
          seen as (select (select count(*) from all1) + (select count(*) from all2)
            + (select count(*) from all3) as n)
        select id, depth, seen.n > (select count(*) from found) as truncated,
          seen.n + 1 as total_visited, 'low' as risk from found, seen""",
    "call_edges nodes",
)
def impact_capped(t):
    found, summary = graph.impact(t.nodes, calls(t), t.generations, "6", max_results=3)
    whole = summary.select(F.struct("truncated", "total_visited", "risk")).scalar()
    return found.withColumn("s", whole).select("id", "depth", "s.*")


# Seeds of the batch questions: every symbol whose number 20 divides.
SEEDS = """
    with recursive r(seed, n, depth) as (
      select id, id, 0 from nodes where cast(symbol_id as bigint) % 20 = 0
      union
      select r.seed, e.src, r.depth + 1 from r join call_edges e on e.dst = r.n where r.depth < 3),
    found as (select seed, n, min(depth) as depth from r group by seed, n)"""


def seeds(t):
    """(seed, id) of the batch questions."""
    return t.nodes.filter(F.col("symbol_id").cast("bigint") % 20 == 0).select(F.col("id").alias("seed"), "id")


@query(
    "gr05_impact_batch",
    f"{SEEDS} select seed, n as id, depth from found where n <> seed",
    "call_edges nodes",
)
def impact_batch(t):
    found, _ = graph.impact_batch(t.nodes, calls(t), seeds(t))
    return found.select("seed", "id", "depth")


@query(
    "gr05_impact_summary",
    f"""{SEEDS}
        select seed, count(*) filter (n <> seed) as affected_symbols,
          count(distinct file) filter (n <> seed) as affected_files,
          false as truncated, count(*) as total_visited,
          case when count(*) > 20 then 'high' when count(*) > 5 then 'medium' else 'low' end as risk
        from found join nodes on n = nodes.id group by seed""",
    "call_edges nodes",
)
def impact_summary(t):
    return graph.impact_batch(t.nodes, calls(t), seeds(t))[1]


def _batch_sql(here: str, there: str) -> str:
    return f"""
        select seed, id, cast(rank as integer) as rank from (
          select e.{here} as seed, n.id, row_number() over (partition by e.{here}
            order by n.qualified_name, n.file, n.line, n.id) as rank
          from (select distinct src, dst from edges where edge_type = 'CALLS') e
            join nodes n on e.{there} = n.id) x
        where rank <= 3"""


@query("gr06_callers_batch", _batch_sql("dst", "src"), "nodes edges")
def callers_batch(t):
    nodes = t.nodes
    seeds = nodes.select(F.col("id").alias("seed"), "id")
    return graph.callers_batch(nodes, t.edges, seeds, limit=3).select("seed", "id", "rank")


@query("gr06_callees_batch", _batch_sql("src", "dst"), "nodes edges")
def callees_batch(t):
    nodes = t.nodes
    seeds = nodes.select(F.col("id").alias("seed"), "id")
    return graph.callees_batch(nodes, t.edges, seeds, limit=3).select("seed", "id", "rank")


# Every supplier asks for the way from its first to its last part.
PAIRS = """
    pairs as (
      select distinct concat('p:', cast(min(l_partkey) as varchar)) as src,
        concat('p:', cast(max(l_partkey) as varchar)) as dst
      from lineitem group by l_suppkey)"""


@query(
    "gr07_shortest_path",
    f"""with recursive {PAIRS.strip()},
        walk(src, dst, node, hops, path) as (
          select src, dst, src, 0, [src] from pairs
          union all
          select w.src, w.dst, e.dst, w.hops + 1, list_append(w.path, e.dst)
          from walk w join call_edges e on e.src = w.node where w.hops < 3 and w.node <> w.dst)
        select src, dst, hops, array_to_string(min(path), '>') as path from (
          select *, min(hops) over (partition by src, dst) as best from walk where node = dst) x
        where hops = best group by src, dst, hops""",
    "call_edges",
)
def shortest_path(t):
    ends = t.lineitem.groupBy("l_suppkey").agg(
        F.min("l_partkey").alias("a"), F.max("l_partkey").alias("b")
    )
    pairs = ends.select(
        F.concat(F.lit("p:"), F.col("a").cast("string")).alias("src"),
        F.concat(F.lit("p:"), F.col("b").cast("string")).alias("dst"),
    )
    found = graph.shortest_path(stored(t.call_edges, "src", "dst"), pairs, max_hops=3)
    return found.withColumn("path", F.array_join("path", ">"))


@query(
    "gr08_valid_edges",
    """select src, dst, edge_type from edges
        where src in (select id from nodes where line > 10)
          and dst in (select id from nodes where line > 10)""",
    "edges nodes",
)
def valid_edges(t):
    return graph.valid_edges(t.edges, t.nodes.filter("line > 10")).select("src", "dst", "edge_type")


@query(
    "gr08_valid_edges_by_tenant",
    """select brain_id, src, dst from tenant_edges
        where (brain_id, src) in (select (brain_id, id) from tenant_nodes)
          and (brain_id, dst) in (select (brain_id, id) from tenant_nodes)""",
    "tenant_nodes tenant_edges",
)
def valid_edges_by_tenant(t):
    return graph.valid_edges(t.tenant_edges, t.tenant_nodes).select("brain_id", "src", "dst")


@query(
    "gr09_recall_by_tenant",
    """select f.brain_id, f.id as fiber_id, n.content,
          case when n.id is null then 'anchor neuron not found' else 'ok' end as status
        from tenant_fibers f left join tenant_nodes n
          on f.anchor_neuron_id = n.id and f.brain_id = n.brain_id""",
    "tenant_fibers tenant_nodes",
)
def recall_by_tenant(t):
    found = graph.recall_detail(t.tenant_fibers, t.tenant_nodes, t.memories)
    return found.select("brain_id", "fiber_id", "content", "status").distinct()


@query(
    "gr09_recall_detail",
    """select f.brain_id, f.id as fiber_id, f.anchor_neuron_id, n.content, m.memory_type, m.priority,
          case when n.id is null then 'anchor neuron not found' else 'ok' end as status
        from fibers f left join (select * from nodes where line > 5) n on f.anchor_neuron_id = n.id
          left join memories m on m.brain_id = f.brain_id and m.fiber_id = f.id""",
    "fibers nodes memories",
)
def recall_detail(t):
    return graph.recall_detail(t.fibers, t.nodes.filter("line > 5"), t.memories)


@query(
    "gr10_fiber_expand",
    """select concat('c:', cast(conv_id as varchar)) as fiber_id, turn as position,
          concat('m:', cast(turn as varchar), role) as neuron_id from conversations""",
)
def fiber_expand(t):
    junction = t.conversations.select(
        F.lit("b").alias("brain_id"),
        F.concat(F.lit("c:"), F.col("conv_id").cast("string")).alias("fiber_id"),
        F.col("turn").cast("int").alias("position"),
        F.concat(F.lit("m:"), F.col("turn").cast("string"), "role").alias("neuron_id"),
    )
    # segments of three positions, so that most fibers have several
    back = graph.explode_fibers(graph.collect_fibers(junction, segment=3))
    return back.select("fiber_id", "position", "neuron_id")


ROUND = """
    select e.dst as id, round(sum(l.level * e.weight) * 0.05, 9) as level
    from {prev} l join edges e on e.src = l.id and e.edge_type = 'CALLS'
    group by e.dst having sum(l.level * e.weight) * 0.05 >= 0.02"""


@query(
    "gr11_spreading_activation",
    f"""with l0 as (select id, cast(1.0 as double) as level from nodes
            where contains(content, 'widget') and line < 10),
        l1 as ({ROUND.format(prev="l0")}), l2 as ({ROUND.format(prev="l1")})
        select id, round(sum(level), 4) as activation, min(round) as first_round from (
          select *, 0 as round from l0 union all select *, 1 from l1
          union all select *, 2 from l2) x group by id""",
    "nodes edges",
)
def spreading_activation(t):
    seeds = t.nodes.filter(F.contains("content", F.lit("widget")) & (F.col("line") < 10))
    links = stored(t.edges.filter("edge_type = 'CALLS'"), "src")
    found = graph.spread(
        links, seeds.select("id", F.lit(1.0).alias("level")), hops=2, decay=0.05, threshold=0.02
    )
    return found.withColumn("activation", F.round("activation", 4))


TENANT_ROUND = """
    select e.brain_id, e.dst as id, round(sum(l.level * e.weight) * 0.05, 9) as level
    from {prev} l join tenant_edges e on e.src = l.id and e.brain_id = l.brain_id
    group by e.brain_id, e.dst having sum(l.level * e.weight) * 0.05 >= 0.002"""


@query(
    "gr11_spreading_by_tenant",
    f"""with l0 as (select brain_id, id, cast(1.0 as double) as level from tenant_nodes where access_frequency < 15),
        l1 as ({TENANT_ROUND.format(prev="l0")}), l2 as ({TENANT_ROUND.format(prev="l1")})
        select brain_id, id, round(sum(level), 6) as activation from (
          select * from l0 union all select * from l1 union all select * from l2) x group by brain_id, id""",
    "tenant_nodes tenant_edges",
)
def spreading_by_tenant(t):
    seeds = t.tenant_nodes.filter("access_frequency < 15").select("brain_id", "id", F.lit(1.0).alias("level"))
    found = graph.spread(t.tenant_edges, seeds, hops=2, decay=0.05, threshold=0.002)
    return found.select("brain_id", "id", F.round("activation", 6).alias("activation"))


@query(
    "ag04_affected_files",
    f"{SEEDS} select distinct seed, file from found join nodes on n = nodes.id where n <> seed",
    "call_edges nodes",
)
def files_of_impact(t):
    found, _ = graph.impact_batch(t.nodes, calls(t), seeds(t))
    return affected_files(found, "seed")
