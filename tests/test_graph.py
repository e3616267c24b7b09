"""Traversals against plain Python on random graphs, with hubs, caps and cycles."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from cairngraph.operators import graph

NODES = (
    "id string, symbol_id string, name string, qualified_name string, kind string, file string, "
    "line int, language string, project_path string, generation_id string"
)
EDGES = "src string, dst string, edge_type string, weight double"


def random_graph(seed, n=60, m=150, hub=True):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    if hub:
        edges |= {(i, 0) for i in range(1, n, 2)}
    nodes = [
        (f"n{i}", f"s{i}", f"x{i}", f"q{rng.randrange(20)}", "function", f"f{i % 7}.py", i % 5,
         "python", "/p", "g")
        for i in range(n)
    ]
    return nodes, [(f"n{a}", f"n{b}", "CALLS", 1.0) for a, b in sorted(edges)]


def brute_impact(nodes, edges, start, max_depth, max_results):
    """Level by level in symbol order, with the cap rule of the batch operator."""
    info = {n[0]: (n[3], n[5], n[6], n[1], n[0]) for n in nodes}
    callers = {}
    for src, dst, *_ in edges:
        callers.setdefault(dst, set()).add(src)
    visited, collected, truncated = {start}, [], False
    level = [start]
    for _ in range(max_depth):
        new = sorted({c for n in level for c in callers.get(n, ())} - visited, key=info.get)
        visited |= set(new)
        room = len(new) if max_results is None else max_results - len(collected)
        level = new[:room]
        truncated |= len(new) > len(level)
        collected += level
    return set(collected), truncated, len(visited)


def brute_queue(nodes, edges, start, max_depth):
    """Uncapped search with a queue, one node at a time."""
    callers = {}
    for src, dst, *_ in edges:
        callers.setdefault(dst, []).append(src)
    seen, queue = {start: 0}, deque([start])
    while queue:
        node = queue.popleft()
        if seen[node] < max_depth:
            for other in callers.get(node, []):
                if other not in seen:
                    seen[other] = seen[node] + 1
                    queue.append(other)
    return {n: d for n, d in seen.items() if n != start}


@pytest.mark.parametrize("cap", [None, 3, 12])
def test_impact_batch_against_brute_force(spark, cap):
    nodes, edges = random_graph(1)
    nodes_df = spark.createDataFrame(nodes, NODES)
    edges_df = spark.createDataFrame(edges, EDGES)
    seeds = nodes_df.select(F.col("id").alias("seed"), "id")
    symbols, summary = graph.impact_batch(nodes_df, edges_df, seeds, 3, cap)
    found, depths = {}, {}
    for row in symbols.collect():
        found.setdefault(row["seed"], set()).add(row["id"])
        depths[row["seed"], row["id"]] = row["depth"]
    totals = {row["seed"]: row for row in summary.collect()}
    assert len(totals) == len(nodes)
    for node in nodes:
        want, truncated, visited = brute_impact(nodes, edges, node[0], 3, cap)
        assert found.get(node[0], set()) == want
        row = totals[node[0]]
        assert (row["truncated"], row["total_visited"]) == (truncated, visited)
        assert row["affected_symbols"] == len(want)
        n = len(want)
        assert row["risk"] == ("high" if n >= 20 else "medium" if n >= 5 else "low")
        if cap is None:
            levels = brute_queue(nodes, edges, node[0], 3)
            assert levels == {i: depths[node[0], i] for i in want}


def test_impact_limits_project_and_unknown_symbol(spark, rows):
    nodes, edges = random_graph(2)
    other = [(*n[:8], "/q" if int(n[0][1:]) % 4 == 0 else "/p", n[9]) for n in nodes]
    nodes_df = spark.createDataFrame(other, NODES)
    edges_df = spark.createDataFrame(edges, EDGES)
    gens = spark.createDataFrame([("g", "/p", "active")], "generation_id string, project_path string, status string")
    inside = {n[0] for n in other if n[8] == "/p"}
    kept = [e for e in edges if e[0] in inside]
    symbols, summary = graph.impact(nodes_df, edges_df, gens, "s1", "/p", 3, None)
    want, _, visited = brute_impact(nodes, kept, "n1", 3, None)
    assert {r["id"] for r in symbols.collect()} == want
    assert summary.head()["total_visited"] == visited
    symbols, summary = graph.impact(nodes_df, edges_df, gens, "none")
    assert symbols.count() == 0
    row = summary.head()
    assert (row["total_visited"], row["truncated"], row["risk"]) == (0, False, "low")


def test_large_frontier_joins_by_shuffle(spark, monkeypatch):
    nodes, edges = random_graph(3)
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(graph, "LITERAL_IDS", 0)
    nodes_df = spark.createDataFrame(nodes, NODES)
    edges_df = spark.createDataFrame(edges, EDGES)
    seeds = nodes_df.select(F.col("id").alias("seed"), "id")
    symbols, _ = graph.impact_batch(nodes_df, edges_df, seeds, 2, None)
    got = {(r["seed"], r["id"]) for r in symbols.select("seed", "id").collect()}
    want = {(n[0], i) for n in nodes for i in brute_impact(nodes, edges, n[0], 2, None)[0]}
    assert got == want


def test_neighbors_and_self_loop(spark, rows):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    edges = spark.createDataFrame(
        [("a", "a", "CALLS", 0.9), ("a", "b", "CALLS", 0.2), ("b", "a", "IMPORTS", 0.5)], EDGES
    )
    ids = spark.createDataFrame([("a",)], "id string")
    both = graph.neighbors(nodes, edges, ids)
    assert rows(both, "id", "direction") == [("a", "in"), ("a", "out"), ("b", "in"), ("b", "out")]
    assert graph.neighbors(nodes, edges, ids, "out", ["CALLS"], 0.5).count() == 1


def test_shortest_path_against_brute_force(spark):
    _, edges = random_graph(4, n=30, m=45, hub=False)
    names = sorted({e[0] for e in edges} | {e[1] for e in edges})
    pairs = [(a, b) for a in names[:12] for b in names]
    pairs_df = spark.createDataFrame(pairs, "src string, dst string")
    edges_df = spark.createDataFrame(edges, EDGES)
    for both in (False, True):
        out = {}
        for src, dst, *_ in edges:
            out.setdefault(src, set()).add(dst)
            if both:
                out.setdefault(dst, set()).add(src)

        def best(a, b):
            level = {a: [a]}
            seen = {a}
            for _ in range(4):
                if b in level:
                    return level[b]
                nxt = {}
                for node, path in level.items():
                    for other in out.get(node, ()):
                        if other not in seen:
                            option = [*path, other]
                            nxt[other] = min(nxt.get(other, option), option)
                seen |= set(nxt)
                level = nxt
            return level.get(b)

        found = graph.shortest_path(edges_df, pairs_df, 4, both)
        got = {(r["src"], r["dst"]): r["path"] for r in found.collect()}
        want = {(a, b): best(a, b) for a, b in pairs}
        assert got == {k: v for k, v in want.items() if v is not None}


def test_fiber_segments_keep_order(spark):
    fibers = spark.createDataFrame(
        [("f1", "b", [f"n{i}" for i in range(25)]), ("f2", "b", ["z", "a"])],
        "id string, brain_id string, neuron_ids array<string>",
    )
    junction = graph.explode_fibers(fibers).repartition(5)
    back = graph.collect_fibers(junction, segment=10).orderBy("fiber_id", "segment").collect()
    assert [(r["fiber_id"], r["segment"], len(r["neuron_ids"])) for r in back] == [
        ("f1", 0, 10), ("f1", 1, 10), ("f1", 2, 5), ("f2", 0, 2),
    ]
    assert [n for r in back if r["fiber_id"] == "f1" for n in r["neuron_ids"]] == [f"n{i}" for i in range(25)]
    assert back[3]["neuron_ids"] == ["z", "a"]


def test_recall_of_unknown_fiber(spark, rows):
    fibers = spark.createDataFrame(
        [("f1", "b", "n1"), ("f2", "b", "lost")], "id string, brain_id string, anchor_neuron_id string"
    )
    nodes = spark.createDataFrame([("n1", "text")], "id string, content string")
    memories = spark.createDataFrame(
        [("b", "f1", "fact", 5)], "brain_id string, fiber_id string, memory_type string, priority int"
    )
    asked = spark.createDataFrame([("b", "f1"), ("b", "f2"), ("b", "f9")], "brain_id string, fiber_id string")
    found = graph.recall_detail(fibers, nodes, memories, asked)
    assert rows(found, "fiber_id", "memory_type", "status") == [
        ("f1", "fact", "ok"),
        ("f2", None, "anchor neuron not found"),
        ("f9", None, "fiber not found"),
    ]


def test_impact_by_sets_equals_pairs(spark, rows):
    """More seeds than a row holds, several start nodes of a seed, a hub; against the search pair by pair."""
    nodes, edges = random_graph(11, n=150, m=500)
    nodes, edges = spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES)
    seeds = nodes.select(F.col("id").alias("seed"), "id").unionByName(
        nodes.filter("line = 2").select(F.lit("several").alias("seed"), "id")
    )
    sets, total = graph.impact_batch(nodes, edges, seeds, max_depth=4)
    pairs, capped = graph.impact_batch(nodes, edges, seeds, max_depth=4, max_results=10_000)
    columns = ("seed", "id", "depth")
    assert rows(sets, *columns) == rows(pairs, *columns)
    assert rows(total) == rows(capped) and total.filter("truncated").count() == 0
    starts, numbers = graph.seed_sets(seeds)
    assert numbers.count() == 151 and numbers.agg(F.max("block")).head()[0] == 2
    calls = edges.select(F.col("dst").alias("id"), F.col("src").alias("caller"))
    levels = graph.reach_sets(calls, starts, 4)
    # a row stands for many pairs
    assert sum(level.count() for level in levels[2:]) < sets.filter("depth >= 2").count() / 5


def test_paths_meet_in_the_middle(spark):
    """Against breadth-first search with the smallest path, in both modes and for every limit."""
    nodes, edges = random_graph(5, n=40, m=70, hub=False)
    ids = [n[0] for n in nodes]
    frame = spark.createDataFrame(edges, EDGES)
    wanted = [(a, b) for a in ids[::3] for b in ids[::4]]
    pairs = spark.createDataFrame([*wanted, wanted[0], (None, "n1"), ("n1", None), ("zz", "n1")], "src string, dst string")
    for both in (False, True):
        out = {}
        for a, b, *_ in edges:
            out.setdefault(a, set()).add(b)
            if both:
                out.setdefault(b, set()).add(a)
        for hops in (1, 4, 5):
            want = {}
            for a, b in set(wanted):
                paths = [[a]]
                for _ in range(hops + 1):
                    hit = [p for p in paths if p[-1] == b]
                    if hit:
                        want[a, b] = min(hit)
                        break
                    best = {}
                    for p in paths:
                        for n in out.get(p[-1], ()):
                            if n not in p:
                                best[n] = min(best.get(n, [*p, n]), [*p, n])
                    paths = list(best.values())
            found = graph.shortest_path(frame, pairs, hops, both).collect()
            assert {(r.src, r.dst): list(r.path) for r in found} == want and len(found) == len(want)
            assert all(r.hops == len(r.path) - 1 for r in found)


def test_tenants_keep_apart(spark, rows):
    nodes = spark.createDataFrame([("a", "n", "own"), ("b", "n", "foreign"), ("a", "m", "x"), ("b", "k", "y")], "brain_id string, id string, content string")
    edges = spark.createDataFrame([("a", "m", "n", "T", 1.0), ("a", "k", "n", "T", 1.0), ("b", "k", "n", "T", 0.5)], "brain_id string, src string, dst string, edge_type string, weight double")
    fibers = spark.createDataFrame([("a", "f", "n"), ("b", "f", "n"), ("c", "f", "n")], "brain_id string, id string, anchor_neuron_id string")
    memories = spark.createDataFrame([], "brain_id string, fiber_id string, memory_type string, priority int")
    assert rows(graph.recall_detail(fibers, nodes, memories), "brain_id", "content") == [("a", "own"), ("b", "foreign"), ("c", None)]
    assert rows(graph.valid_edges(edges, nodes), "brain_id", "src") == [("a", "m"), ("b", "k")]
    assert rows(graph.neighbors(nodes, edges, direction="out"), "brain_id", "node_id", "content") == [("a", "k", "own"), ("a", "m", "own"), ("b", "k", "foreign")]
    ids = spark.createDataFrame([("b", "n")], "brain_id string, id string")
    assert rows(graph.neighbors(nodes, edges, ids, "in"), "brain_id", "node_id", "id") == [("b", "n", "k")]
    seeds = spark.createDataFrame([("a", "m", 1.0), ("b", "k", 1.0)], "brain_id string, id string, level double")
    assert rows(graph.spread(edges, seeds, 1, 1.0, 0.1).filter("id = 'n'"), "brain_id", "activation") == [("a", 1.0), ("b", 0.5)]


@pytest.mark.parametrize("segment", [1, 3, 10, 10_000])
def test_fiber_lists_round_trip(spark, rows, segment):
    """Lists over the segment size, gaps, late first positions."""
    items = [("b", "long", i, f"n{i % 7}") for i in range(25)] + [("b", "gaps", i * i, f"m{i}") for i in range(12)] + [("c", "late", 7 + i, "k") for i in range(4)]
    junction = spark.createDataFrame(items, "brain_id string, fiber_id string, position int, neuron_id string").repartition(4)
    collected = graph.collect_fibers(junction, segment)
    assert rows(graph.explode_fibers(collected)) == sorted(items, key=repr)
    assert collected.agg(F.max(F.size("neuron_ids"))).head()[0] <= segment


def test_level_filters_reach_the_files(spark):
    """Few frontier ids are a filter of the scan of a stored edge table, and only asked columns are read."""
    from cairngraph.session import stored

    _, edges = random_graph(3)
    kept = stored(spark.createDataFrame(edges, EDGES), "dst", "src")
    links = kept.select(F.col("dst").alias("id"), F.col("src").alias("caller"))
    frontier = spark.createDataFrame([("n1",), ("n2",)], "id string")
    met = graph.step_from(links, frontier, "id")
    plan = met._jdf.queryExecution().toString()
    assert "In(dst, [n1,n2])" in plan.replace("n2,n1", "n1,n2") and "weight" not in plan.split("ReadSchema")[-1].split("\n")[0]
    assert {(r["id"], r["caller"]) for r in met.collect()} == {(b, a) for a, b, *_ in edges if b in ("n1", "n2")}
