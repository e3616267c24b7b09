"""Plans that keep their cost a row when tables grow, on rows written here."""

import pytest
from pyspark.sql import functions as F

from cairngraph.operators import resolve
from cairngraph.plans import bindings, code_queries, search_queries
from cairngraph.plans.bindings import Tables


def _parts_and_lines(spark, folder):
    """A few parts and the orders that name them in turn."""
    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    rows = [(i, "a b", "Brand#11", "T", 20) for i in range(4)]
    spark.createDataFrame(rows, part).write.parquet(f"{folder}/part.parquet")
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string"
    rows = [(o, (o + k) % 4, 1, k, 1.0, 0.1, "N") for o in range(3) for k in range(3)]
    spark.createDataFrame(rows, line).write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


def test_bindings_broadcast_no_growing_table(spark, tmp_path, capsys):
    t = _parts_and_lines(spark, tmp_path)
    edges = t.tenant_edges
    assert edges.count() == 8
    edges.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_dedupe_reads_its_edges_from_one_scan(spark, tmp_path, capsys):
    t = _parts_and_lines(spark, tmp_path)
    kept = code_queries.dedupe_edges(t)
    assert kept.count() == t.edges.count() == 4
    kept.explain()
    assert "parquet" not in capsys.readouterr().out


def test_posting_lists_add_up_once(spark, tmp_path, capsys):
    """A list of n documents takes n additions, not n * n."""
    rows = [(i, "one two" if i % 2 else "one") for i in range(130)] + [(5, "one two"), (None, "one"), (200, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = search_queries.posting_blocks(Tables(spark, str(tmp_path)))
    got = {(r.token, r.block_no): (r.ids, r.n) for r in found.collect()}
    want = {("one", b): list(range(64 * b, min(130, 64 * b + 64))) for b in range(3)} | {("two", b): [i for i in range(64 * b, min(130, 64 * b + 64)) if i % 2] for b in range(3)}
    assert got == {k: (",".join(map(str, v)), len(v)) for k, v in want.items()}
    found.explain()
    assert "slice(" not in capsys.readouterr().out


def test_references_and_imports_share_their_edges(spark, tmp_path):
    t = _parts_and_lines(spark, tmp_path)
    found = code_queries.name_resolution(t)
    assert {tuple(r) for r in found.select("raw_name", "rule").collect()} == {("C1", 3), ("C2", 3), ("C3", 3), ("self.C0", None)}
    for frame in (t.edges, found):
        assert not any("lineitem" in file for file in frame.inputFiles())


def test_names_are_looked_up_once_per_key(spark, capsys):
    """A name without containers is one key, however many name spaces it is tried in."""
    symbol = "project string, file string, ord int, name string, qualified_name string, kind string, line int, language string, signature string, symbol_id string"
    names = ["x", "C", "C.x", "C.D", "C.D.y", "C.D.x", "z", "C.z", "E.e"]
    symbols = [("/p", "f", i, n.split(".")[-1], n, "function", 1, "python", "", n.upper()) for i, n in enumerate(names)]
    symbols += [("/p", "g", 1, "x", "x", "function", 1, "python", "", "G"), ("/p", "f", 20, "lost", "lost", "function", 1, "python", "", None)]
    bindings = [("/p", "f", "b", "B"), ("/p", "f", "z", "BOUND")]
    wanted = [
        ((), "z", "BOUND", 1), ((), "b", "B", 1), (("C",), "self.z", "C.Z", 2), (("C", "D"), "this.z", "C.Z", 2),
        (("C", "D"), "self.x", "C.X", 2), ((), "x", "X", 3), (("E",), "self.x", "X", 3), ((), "lost", None, 3),
        (("C",), "D", "C.D", 4), (("C", "D"), "y", "C.D.Y", 4), (("C", "Q"), "D", "C.D", 5), ((), "e", "E.E", 6),
        ((), "self.z", None, None), ((), "", None, None), ((), None, None, None), (None, "x", None, None),
    ]
    refs = [("/p", "f", None if c is None else list(c), raw, i) for i, (c, raw, *_) in enumerate(wanted)]
    refs += [(None, "f", [], "x", 98), ("/p", "f", [], "x", 99)]
    refs = spark.createDataFrame(refs, "project string, file string, containers array<string>, raw_name string, ord int")
    found = resolve.resolve_names(
        refs, spark.createDataFrame(symbols, symbol), spark.createDataFrame(bindings, "project string, file string, binding_name string, target_sid string")
    )
    got = {r.ord: (r.target_sid, r.rule) for r in found.collect()}
    assert got == {i: (sid, rule) for i, (_, _, sid, rule) in enumerate(wanted)} | {98: (None, None), 99: ("X", 3)}
    keys = refs.filter("ord = 5").select(resolve.F.explode(resolve._candidates()).alias("c")).filter("c is not null")
    assert keys.count() == 1
    found.explain()
    assert "lambdafunction" not in capsys.readouterr().out


def _code_base(spark, folder):
    """Parts that repeat, once as they are and once in another file, parts with nulls, and lines of every kind."""
    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    rows = [(i, f"n{i % 5} b", f"Brand#1{i % 3}", "T", 18 + i % 4) for i in range(24)]
    rows += [rows[1], rows[2], (3, "n3 b", "Brand#44", "T", 21), (24, None, "Brand#11", "T", 20), (25, "q", None, "T", 22), (None, "q", "Brand#11", "T", 20)]
    spark.createDataFrame(rows, part).write.parquet(f"{folder}/part.parquet")
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string"
    rows = [(o, (o * 5 + k * k) % 28, 1, 1 + (k + o) % 8, 1.0, k / 100, "NAR"[(o + k // 2) % 3]) for o in range(40) for k in range(7)]
    rows += rows[:9] + [(41, None, 1, 1, 1.0, 0.1, "N"), (41, 2, 1, 2, 1.0, None, None), (41, 3, 1, 3, None, 0.2, None), (None, 1, 1, 1, 1.0, 0.1, "A"), (None, 2, 1, 2, 1.0, 0.1, "A")]
    spark.createDataFrame(rows, line).write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


@pytest.mark.parametrize("name", ["edges", "refs", "py_imports"])
def test_bindings_written_for_spark_have_the_same_rows(spark, tmp_path, rows, name):
    t = _code_base(spark, tmp_path)
    assert name in bindings.WRITTEN_FOR_SPARK
    got, want = getattr(t, name), t.sql(bindings.BINDINGS[name])
    assert got.dtypes == want.dtypes and want.count() > 50
    if name == "py_imports":  # imports of copies tie: any of them may come first
        assert rows(got.drop("ord")) == rows(want.drop("ord"))
        assert rows(got, "file", "ord", "line") == rows(want, "file", "ord", "line")
    else:
        assert rows(got) == rows(want)


def test_call_edges_hash_what_they_look_up(spark, tmp_path, rows, capsys):
    """candidates and imports are not sorted to be looked up, only references to meet their hits."""
    t = _code_base(spark, tmp_path)
    found = code_queries.call_edges(t)
    assert found.count() > 10 and "refs" not in vars(t)
    assert set(t.edges.columns) == {"src", "dst", "edge_type", "line"}
    for frame, merged in ((found, 1), (t.refs, 0)):
        capsys.readouterr()
        frame.explain()
        plan = capsys.readouterr().out
        assert "ShuffledHashJoin" in plan and plan.count("SortMergeJoin") == merged and "Broadcast" not in plan
    # References are numbered before their source's name and file are joined to them.
    assert plan.index("ShuffledHashJoin") < plan.index("row_number()")
    once = Tables(spark, str(tmp_path))
    want = resolve.call_edges(_with_containers(once.sql(bindings.BINDINGS["refs"]).filter("edge_type = 'CALLS'")), once.symbols, code_queries._bindings(once))
    assert rows(found) == rows(want, *found.columns)


def test_inheritance_edges_leave_calls_out(spark, tmp_path, rows):
    """only the edges that bases and imports come from are written and joined."""
    t = _code_base(spark, tmp_path)
    found = code_queries.inheritance_edges(t)
    assert {r.edge_type for r in t.edges.select("edge_type").collect()} == {"EXTENDS", "IMPORTS"}
    assert "refs" not in vars(t)
    once = Tables(spark, str(tmp_path))
    bases = _with_containers(once.sql(bindings.BINDINGS["refs"]).filter("edge_type = 'EXTENDS'"))
    bases = bases.withColumnsRenamed({"src_qname": "class_qname", "raw_name": "base_name", "edge_type": "relation"})
    want = resolve.inheritance_edges(bases, once.symbols, code_queries._bindings(once))
    assert found.count() > 5 and rows(found) == rows(want, *found.columns)


def _with_containers(refs):
    return refs.withColumn("containers", F.expr("if(container_text = '', array(), split(container_text, '[.]'))"))
