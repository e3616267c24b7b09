"""Code-graph fixtures: symbols, edges, index runs, search and impact."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cairngraph.operators import facts as facts_ops
from cairngraph.operators import graph, lifecycle, resolve
from cairngraph.operators.facts import file_facts
from cairngraph.operators.search import search
from cairngraph.plans.index_job import IndexRunFailed, generation_key, index_project, index_projects
from cairngraph.schemas import FILES, SYMBOLS
from cairngraph.session import compact, cut, scratch

PROJECT = "/proj"


def files_of(spark, sources, project=PROJECT):
    rows = [(project, path, len(text), text) for path, text in sources.items()]
    return spark.createDataFrame(rows, FILES)


def named_edges(edges, symbols):
    names = symbols.select("symbol_id", "qualified_name")
    joined = edges.join(
        names.toDF("source_sid", "source"), "source_sid"
    ).join(names.toDF("target_sid", "target"), "target_sid")
    return {(r["source"], r["target"], r["type"]) for r in joined.collect()}


def graph_of(spark, sources):
    files = files_of(spark, sources)
    defs, imports, bases, calls, errors = facts_ops.extract_facts(files)
    healthy = facts_ops.healthy_files(files, errors)
    symbols = cut(resolve.all_symbols(healthy, defs))
    resolved = resolve.resolve_python_modules(imports, files)
    return symbols, cut(resolve.all_edges(symbols, resolved, bases, calls)), errors


UTIL = "def helper():\n    return 'ok'"


def test_python_symbols_and_edges(spark, rows):
    sample = (
        "from util import helper\n\nclass Base:\n    pass\n\n"
        "class Greeter(Base):\n    def greet(self):\n        helper()"
    )
    symbols, edges, _ = graph_of(spark, {"util.py": UTIL, "sample.py": sample})
    ours = symbols.filter("file = 'sample.py'")
    assert rows(ours, "qualified_name", "kind") == [
        ("Base", "class"),
        ("Greeter", "class"),
        ("Greeter.greet", "method"),
        ("sample.py", "module"),
    ]
    assert named_edges(edges, symbols) == {
        ("sample.py", "util.py", "IMPORTS"),
        ("sample.py", "Base", "CONTAINS"),
        ("sample.py", "Greeter", "CONTAINS"),
        ("Greeter", "Greeter.greet", "CONTAINS"),
        ("Greeter", "Base", "EXTENDS"),
        ("Greeter.greet", "helper", "CALLS"),
        ("util.py", "helper", "CONTAINS"),
    }


def test_fact_details():
    text = (
        "import a.b as c, d.e\n"
        "from . import x as y, z\n"
        "from m import *\n"
        "@deco(1)\n"
        "async def f(a: int = g(),\n        *b) -> h():\n"
        "    def inner(): return self.q() + (k)()\n"
        "    obj . call ()\n"
        "class K(m.Base, Generic[T], metaclass=M):\n"
        "    class L(K): pass\n"
        "def gen[T: (int, str)](v: T): return v.w().z()\n"
    )
    facts = file_facts(text)
    defs = [f for f in facts if f["fact"] == "def"]
    assert [(d["qualified_name"], d["kind"], d["signature"], d["line"]) for d in defs] == [
        ("f", "function", "(a: int = g(),\n        *b)", 5),
        ("f.inner", "method", "()", 7),
        ("K", "class", "", 9),
        ("K.L", "class", "", 10),
        ("gen", "function", "(v: T)", 11),
    ]
    imports = [f for f in facts if f["fact"] == "import"]
    assert [(i["module_spec"], i["imported_name"], i["binding_name"]) for i in imports] == [
        ("a.b", None, "c"),
        ("d.e", None, "e"),
        (".", "x", "y"),
        (".", "z", "z"),
        ("m", "*", None),
    ]
    bases = [f for f in facts if f["fact"] == "base"]
    assert [(b["qualified_name"], b["raw_name"], b["containers"]) for b in bases] == [
        ("K", "m.Base", []),
        ("K.L", "K", ["K"]),
    ]
    calls = [(f["qualified_name"], f["raw_name"], tuple(f["containers"])) for f in facts if f["fact"] == "call"]
    assert set(calls) == {
        ("f", "g", ()),
        ("f", "h", ()),
        ("f", "self.q", ()),
        ("f.inner", "self.q", ("f",)),
        ("f", "", ()),
        ("f.inner", "", ("f",)),
        ("f", "obj.call", ()),
        ("gen", "v.w().z", ()),
        ("gen", "v.w", ()),
    }


def test_broken_file_leaves_no_rows(spark, rows):
    symbols, _, errors = graph_of(spark, {"good.py": UTIL, "bad.py": "def x(:\n"})
    assert rows(symbols.select("file").distinct()) == [("good.py",)]
    assert errors.count() == 1


def ts_facts(spark):
    """Facts of a TypeScript project, as another extractor would deliver them."""
    defs = spark.createDataFrame(
        [
            (PROJECT, "mod.ts", 1, "Runner", "Runner", "interface", 1, "", "typescript"),
            (PROJECT, "mod.ts", 2, "Base", "Base", "class", 2, "", "typescript"),
            (PROJECT, "mod.ts", 3, "helper", "helper", "function", 3, "()", "typescript"),
            (PROJECT, "sample.ts", 1, "Greeter", "Greeter", "class", 2, "", "typescript"),
            (PROJECT, "sample.ts", 2, "run", "Greeter.run", "method", 3, "()", "typescript"),
        ],
        "project string, file string, ord int, name string, qualified_name string, kind string, "
        "line int, signature string, language string",
    )
    imports = spark.createDataFrame(
        [(PROJECT, "sample.ts", i, 1, "from", "./mod", n, n) for i, n in enumerate(["Base", "Runner", "helper"])],
        "project string, file string, ord int, line int, form string, module_spec string, "
        "imported_name string, binding_name string",
    )
    bases = spark.createDataFrame(
        [
            (PROJECT, "sample.ts", 0, "Greeter", [], "Base", "EXTENDS", 2),
            (PROJECT, "sample.ts", 1, "Greeter", [], "Runner", "IMPLEMENTS", 2),
        ],
        "project string, file string, ord int, class_qname string, containers array<string>, "
        "base_name string, relation string, line int",
    )
    calls = spark.createDataFrame(
        [(PROJECT, "sample.ts", 0, "Greeter.run", ["Greeter"], "helper", 4)],
        "project string, file string, ord int, src_qname string, containers array<string>, "
        "raw_name string, line int",
    )
    return {"defs": defs, "imports": imports, "bases": bases, "calls": calls}


def test_typescript_facts(spark):
    files = files_of(spark, {"mod.ts": "", "sample.ts": ""})
    tables, report = index_project(spark, files, facts=ts_facts(spark), now="t")
    tables = {name: cut(frame) for name, frame in tables.items()}
    assert report.head()["status"] == "success"
    nodes = tables["nodes"].select("id", "qualified_name")
    found = tables["edges"].join(nodes.toDF("src", "s"), "src").join(nodes.toDF("dst", "d"), "dst")
    ours = {(r["s"], r["d"], r["edge_type"]) for r in found.collect() if r["s"] in ("sample.ts", "Greeter", "Greeter.run")}
    assert ours == {
        ("sample.ts", "mod.ts", "IMPORTS"),
        ("sample.ts", "Greeter", "CONTAINS"),
        ("Greeter", "Greeter.run", "CONTAINS"),
        ("Greeter", "Base", "EXTENDS"),
        ("Greeter", "Runner", "IMPLEMENTS"),
        ("Greeter.run", "helper", "CALLS"),
    }


def test_planned_only(spark):
    files = files_of(spark, {"main.go": "package main"})
    _, report = index_project(spark, files)
    row = report.head()
    assert (row["status"], row["files_scanned"], row["planned_files"]) == ("unsupported", 0, 1)
    assert row["planned_languages"] == ["go"]
    _, report = index_project(spark, files_of(spark, {"notes.txt": "x"}))
    assert report.head()["status"] == "error"


def test_index_end_to_end(spark, rows):
    service = "from util import helper\n\ndef run():\n    return helper()"
    files = files_of(spark, {"util.py": UTIL, "service.py": service})
    tables, report = index_project(spark, files, force=True, now="2026-01-01")
    row = report.head()
    assert (row["status"], row["symbols"], row["edges"], row["skipped"]) == ("success", 4, 4, 0)
    assert row["generation_id"] == generation_key(PROJECT, "2026-01-01")
    nodes, edges, gens = tables["nodes"], tables["edges"], tables["generations"]
    run = search(nodes, gens, "run", PROJECT).head()
    assert run["qualified_name"] == "run"
    helper = graph.callees(nodes, edges, gens, run["symbol_id"], PROJECT).collect()
    assert [r["qualified_name"] for r in helper] == ["helper"]
    symbols, summary = graph.impact(nodes, edges, gens, helper[0]["symbol_id"], PROJECT)
    assert rows(symbols, "qualified_name") == [("run",)]
    assert summary.head()["total_visited"] == 2
    # Indexing again makes the first generation gc and keeps the answers.
    again, report = index_project(spark, files, tables, now="2026-01-02")
    assert rows(again["generations"], "status") == [("active",), ("gc",)]
    assert search(again["nodes"], again["generations"], "run", PROJECT).count() == 1
    forced, _ = index_project(spark, files, again, force=True, now="2026-01-03")
    assert forced["nodes"].count() == 4 and forced["edges"].count() == 4
    assert forced["generations"].count() == 1


def test_index_skips_broken_file(spark, rows):
    good = UTIL + "\n\ndef run():\n    return helper()"
    files = files_of(spark, {"good.py": good, "broken.py": "def stable(:\n"})
    tables, report = index_project(spark, files, now="t")
    row = report.head()
    assert (row["status"], row["files_scanned"], row["skipped"]) == ("success", 2, 1)
    assert rows(tables["nodes"].select("file").distinct()) == [("good.py",)]
    found = search(tables["nodes"], tables["generations"], "run", PROJECT)
    assert rows(found, "qualified_name") == [("run",)]
    _, report = index_project(spark, files_of(spark, {"broken.py": "def ("}), now="t")
    assert (report.head()["status"], report.head()["symbols"]) == ("error", 0)


def test_projects_go_their_own_ways(spark, rows):
    """One run: a project that works, one that cannot be read, one without supported files, one written relative."""
    parts = [files_of(spark, {"u.py": UTIL}, "/a"), files_of(spark, {"u.py": "def ("}, "/b/../b"), files_of(spark, {"m.go": ""}, "/c"), files_of(spark, {"u.py": UTIL, "v.py": UTIL}, "rel/x")]
    files = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    first, report = index_projects(spark, files, now="1")
    assert rows(report, "project", "status", "symbols", "skipped") == [("/a", "success", 2, 0), ("/b", "error", 0, 1), ("/c", "unsupported", 0, 0), ("/rel/x", "success", 4, 0)]
    assert rows(first["generations"], "project_path", "status") == [("/a", "active"), ("/b", "failed"), ("/rel/x", "active")]
    assert first["generations"].filter("status = 'building'").count() == 0
    assert generation_key("rel/x", "1") in {r["generation_id"] for r in first["generations"].collect()}
    # the next run breaks /a and mends /b: each keeps or changes its own generation
    again = files_of(spark, {"u.py": "def ("}, "/a").unionByName(files_of(spark, {"u.py": UTIL}, "/b"))
    second, _ = index_projects(spark, again, first, now="2")
    assert rows(second["generations"], "project_path", "created_at", "status") == [
        ("/a", "1", "active"), ("/a", "2", "failed"), ("/b", "1", "failed"), ("/b", "2", "active"), ("/rel/x", "1", "active"),
    ]
    forced, _ = index_projects(spark, again, second, now="3", force=True)
    assert rows(forced["generations"], "project_path", "created_at") == [("/a", "3"), ("/b", "3"), ("/rel/x", "1")]
    assert rows(forced["nodes"].select("project_path").distinct()) == [("/b",), ("/rel/x",)]


def test_lost_rows_and_errors_fail_the_generation(spark, rows):
    files = files_of(spark, {"u.py": UTIL}, "/a").unionByName(files_of(spark, {"u.py": UTIL}, "/b"))
    first, _ = index_projects(spark, files, now="1")

    def lossy(name, frame):
        return cut(frame.filter("project_path <> '/a'") if name == "edges" else frame)

    second, report = index_projects(spark, files, first, now="2", write=lossy)
    assert rows(report, "project", "status") == [("/a", "error"), ("/b", "success")]
    assert rows(second["generations"], "project_path", "created_at", "status") == [("/a", "1", "active"), ("/a", "2", "failed"), ("/b", "1", "gc"), ("/b", "2", "active")]
    assert "edge rows stored" in second["generations"].filter("status = 'failed'").head()["error"]

    def broken(name, frame):
        raise OSError("disk full")

    with pytest.raises(IndexRunFailed) as caught:
        index_projects(spark, files, first, now="3", write=broken)
    gens = caught.value.tables["generations"]
    assert rows(gens, "project_path", "created_at", "status") == [("/a", "1", "active"), ("/a", "3", "failed"), ("/b", "1", "active"), ("/b", "3", "failed")]
    assert gens.filter("created_at = '3'").head()["error"] == "disk full"


def test_a_run_keeps_little_on_disk(spark, rows, tmp_path):
    """Rows are stored compressed, what only the run needs goes with it, and shuffle files go with each of its queries."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    shared, before, seen = spark.conf.get("spark.checkpoint.dir"), spark.conf.get(key), []

    def watched(name, frame):
        seen.append(spark.conf.get(key))
        return compact(frame)

    first, _ = index_projects(spark, files_of(spark, {"u.py": UTIL}, "/a"), now="1")
    second, _ = index_projects(spark, files_of(spark, {"u.py": UTIL}, "/a"), first, now="2", write=watched)
    for tables in (first, second):
        assert all(tables[t].inputFiles() and all(f.endswith(".zstd.parquet") for f in tables[t].inputFiles()) for t in ("nodes", "edges"))
    assert seen == ["true"] * 2 and spark.conf.get(key) == before
    third, _ = index_projects(spark, files_of(spark, {"u.py": UTIL}, "/a"), second, now="3", write=lambda name, frame: frame)
    assert third["nodes"].count() == 3 * first["nodes"].count() and third["edges"].count() == 3 * first["edges"].count()
    with pytest.raises(ValueError), scratch(spark) as keep:
        kept = keep(first["nodes"])
        assert kept.count() == first["nodes"].count() and len(list(Path(shared).glob("scratch-*"))) == 1
        raise ValueError
    assert not list(Path(shared).glob("scratch-*"))
    assert rows(second["generations"], "created_at", "status") == [("1", "gc"), ("2", "active")]


def test_equal_definitions_are_one_symbol(spark, rows):
    text = "def f(a):\n    return 1\n\ndef f(a):\n    return g()\n\ndef g():\n    return f(2)\n"
    tables, report = index_project(spark, files_of(spark, {"twice.py": text}), now="t")
    row = report.head()
    assert (row["status"], row["symbols"], row["duplicate_symbols"]) == ("success", 3, 1)
    links = tables["edges"].filter("edge_type = 'CALLS'")
    assert links.count() == 2


def test_module_resolution(spark):
    files = files_of(
        spark,
        {
            "pkg/a.py": "", "pkg/__init__.py": "", "pkg/sub/b.py": "", "top.py": "",
            "web/x.ts": "", "web/y.js": "", "web/dir/index.tsx": "", "web/data.json": "",
        },
    )
    cases = {
        ("pkg/sub/b.py", "..a"): "pkg/a.py",
        ("pkg/sub/b.py", ".."): "pkg/__init__.py",
        ("pkg/sub/b.py", "...top"): "top.py",
        ("pkg/sub/b.py", "....top"): None,
        ("pkg/sub/b.py", "pkg"): "pkg/__init__.py",
        ("pkg/sub/b.py", "pkg.a"): "pkg/a.py",
        ("pkg/sub/b.py", "a"): None,
        ("top.py", ".top"): "top.py",
    }
    js = {
        ("web/x.ts", "./y"): "web/y.js",
        ("web/x.ts", "./dir"): "web/dir/index.tsx",
        ("web/x.ts", "../web/./y.js"): "web/y.js",
        ("web/x.ts", "./y.ts"): None,
        ("web/x.ts", "./data.json"): None,
        ("web/x.ts", "../../web/y"): None,
        ("web/x.ts", "y"): None,
        ("web/dir/index.tsx", ".."): None,
    }
    schema = "project string, file string, module_spec string, want string"

    def frame(wanted):
        return spark.createDataFrame([(PROJECT, f, m, w) for (f, m), w in wanted.items()], schema)

    for resolver, wanted in ((resolve.resolve_python_modules, cases), (resolve.resolve_js_modules, js)):
        found = resolver(frame(wanted), files)
        bad = found.filter(~F.col("want").eqNullSafe(F.col("target_file")))
        assert bad.collect() == []
        assert found.count() == len(wanted)


def brute_resolve(raw, containers, symbols, bindings):
    """The cascade for one reference, over (name, qualified_name, sid) in file order."""
    if not raw:
        return None
    if raw in bindings:
        return bindings[raw]
    qualified = {q: s for _, q, s in symbols}
    if containers and raw.split(".")[0] in ("self", "this") and "." in raw:
        raw = raw.split(".", 1)[1]
        if f"{containers[0]}.{raw}" in qualified:
            return qualified[f"{containers[0]}.{raw}"]
    tried = [raw]
    if containers:
        tried += [".".join([*containers, raw]), f"{containers[0]}.{raw}"]
    for name in tried:
        if name in qualified:
            return qualified[name]
    same = [(q, s) for n, q, s in symbols if n == raw]
    if len(same) == 1:
        return same[0][1]
    top = [s for q, s in same if "." not in q]
    return top[0] if len(top) == 1 else None


def test_name_resolution_against_brute_force(spark):
    import random

    rng = random.Random(5)
    names = ["a", "b", "c", "d"]
    symbols, by_file = [], {}
    bindings, bound = [], {}
    for file in ("f1.py", "f2.py", "f3.py"):
        by_file[file], bound[file] = [], {}
        for order in range(1, 12):
            path = [rng.choice(names) for _ in range(rng.choice([1, 1, 2, 3]))]
            sid = f"{file}:{order}"
            q = ".".join(path)
            by_file[file].append((path[-1], q, sid))
            symbols.append((PROJECT, file, order, path[-1], q, "function", 1, "python", "", sid))
        for n in rng.sample(names, 1):
            bound[file][n] = f"bound:{n}"
            bindings.append((PROJECT, file, n, f"bound:{n}"))
    refs = []
    for file in by_file:
        for _ in range(200):
            raw = ".".join(rng.choice(names) for _ in range(rng.choice([1, 1, 2])))
            raw = rng.choice(["", "self.", "this.", ""]) + raw
            containers = [rng.choice(names) for _ in range(rng.choice([0, 1, 2]))]
            refs.append((PROJECT, file, containers, rng.choice([raw, raw, raw, ""])))
    symbols_df = spark.createDataFrame(
        symbols,
        "project string, file string, ord int, name string, qualified_name string, kind string, "
        "line int, language string, signature string, symbol_id string",
    )
    bindings_df = spark.createDataFrame(
        bindings, "project string, file string, binding_name string, target_sid string"
    )
    refs_df = spark.createDataFrame(
        refs, "project string, file string, containers array<string>, raw_name string"
    )
    got = resolve.resolve_names(refs_df, symbols_df, bindings_df).collect()
    assert len(got) == len(refs)
    for row in got:
        want = brute_resolve(row["raw_name"], row["containers"], by_file[row["file"]], bound[row["file"]])
        assert row["target_sid"] == want, row


def test_generation_lifecycle(spark, rows):
    def symbol(name, file, line, kind="function"):
        return (PROJECT, file, 1, name, name, kind, line, "python", "")

    def symbols(*items):
        frame = spark.createDataFrame(
            list(items),
            "project string, file string, ord int, name string, qualified_name string, "
            "kind string, line int, language string, signature string",
        )
        return resolve.with_symbol_id(frame)

    module = symbol("alpha.py", "alpha.py", 1, "module")
    store = lifecycle.empty_store(spark)
    one = symbols(module, symbol("alpha", "alpha.py", 1), symbol("beta", "alpha.py", 4))
    sid = {r["name"]: r["symbol_id"] for r in one.collect()}
    edges = spark.createDataFrame(
        [
            (PROJECT, sid["alpha.py"], sid["alpha"], "CONTAINS", 1),
            (PROJECT, sid["alpha.py"], sid["beta"], "CONTAINS", 4),
            (PROJECT, sid["alpha"], sid["beta"], "CALLS", 2),
            (PROJECT, sid["alpha"], "nowhere", "CALLS", 3),
        ],
        "project string, source_sid string, target_sid string, type string, line int",
    )
    gens = lifecycle.create_generation(store["generations"], PROJECT, "n1")
    g1, g2, g3 = (generation_key(PROJECT, n) for n in ("n1", "n2", "n3"))
    assert gens.head()["generation_id"] == g1 and gens.head()["status"] == "building"
    nodes = lifecycle.store_symbols(store["nodes"], one, g1)
    links = lifecycle.store_edges(store["edges"], edges, nodes, g1)
    assert lifecycle.store_edges(links, edges, nodes, g1).count() == 3
    with pytest.raises(lifecycle.CountMismatch):
        lifecycle.activate(gens, nodes, links, g1, PROJECT, symbol_count=2)
    gens = lifecycle.activate(gens, nodes, links, g1, PROJECT, 3, 3)
    assert [r["qualified_name"] for r in search(nodes, gens, "alpha", PROJECT).collect()] == ["alpha", "alpha.py"]
    assert rows(graph.callees(nodes, links, gens, sid["alpha"], PROJECT), "name") == [("beta",)]
    assert rows(graph.callers(nodes, links, gens, sid["beta"], PROJECT), "name") == [("alpha",)]
    found, _ = graph.impact(nodes, links, gens, sid["beta"], PROJECT)
    assert rows(found, "name", "file") == [("alpha", "alpha.py")]

    gens = lifecycle.create_generation(gens, PROJECT, "n2")
    nodes = lifecycle.store_symbols(nodes, symbols(module, symbol("beta_v2", "alpha.py", 4)), g2)
    gens = lifecycle.activate(gens, nodes, links, g2, PROJECT, 2, 0)
    assert rows(search(nodes, gens, "beta", PROJECT), "name") == [("beta_v2",)]

    gens = lifecycle.create_generation(gens, PROJECT, "n3")
    nodes = lifecycle.store_symbols(nodes, symbols(symbol("gamma", "gamma.py", 1)), g3)
    gens = lifecycle.fail(gens, g3, "boom")
    assert search(nodes, gens, "gamma", PROJECT).count() == 0
    assert {r["generation_id"]: (r["status"], r["error"]) for r in gens.collect()} == {
        g1: ("gc", None),
        g2: ("active", None),
        g3: ("failed", "boom"),
    }


def test_joins_of_growing_sides_broadcast_none(spark, capsys):
    """Of tables that look small both sides are shuffled: a broadcast would pass the driver whole."""
    from cairngraph.operators.graph import valid_edges

    symbols = spark.createDataFrame([("/p", "f.py", 1, "a", "a", "function", 1, "python", "()", "s1")], SYMBOLS)
    refs = spark.createDataFrame([("/p", "f.py", ["a"], "a")], "project string, file string, containers array<string>, raw_name string")
    bound = spark.createDataFrame([("/p", "f.py", "a", "s1")], "project string, file string, binding_name string, target_sid string")
    found = resolve.resolve_names(refs, symbols, bound)
    edges = valid_edges(spark.createDataFrame([("x", "y")], "src string, dst string"), spark.createDataFrame([("x",), ("y",)], "id string"))
    assert found.count() == 1 and edges.count() == 1
    for frame in (found, edges):
        frame.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
