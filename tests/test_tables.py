"""Table changes, exchange, checks, vectors, text and the change feed on small fixtures."""

import json
import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairngraph.functions import scalars as S
from cairngraph.operators import checks, lifecycle, search, tables, vectors
from cairngraph.operators.common import top_n, with_position
from cairngraph.sources import exchange, files, snapshots
from cairngraph.streaming import changes

CREATED = datetime(2026, 3, 30, 7, 4, 35, tzinfo=UTC)


def fibers_of(spark):
    rows = [
        ("fiber-pre-2026", "b", CREATED, datetime(2022, 3, 4, 23, 9, 20, tzinfo=UTC), 0.5),
        ("fiber-before-created", "b", CREATED, datetime(2026, 3, 1, tzinfo=UTC), 0.5),
        ("fiber-valid", "b", CREATED, datetime(2026, 4, 1, tzinfo=UTC), 0.5),
        ("fiber-unused", "b", CREATED, None, 0.5),
    ]
    return spark.createDataFrame(
        rows, "id string, brain_id string, created_at timestamp, last_conducted timestamp, salience double"
    )


def test_repair(spark, rows):
    fibers = fibers_of(spark)
    dry, candidates = lifecycle.repair(fibers)
    assert rows(candidates, "id", "reason") == [
        ("fiber-before-created", "before-created"),
        ("fiber-pre-2026", "pre2026"),
    ]
    assert dry is fibers
    fixed, _ = lifecycle.repair(fibers, apply=True)
    iso = dict(rows(fixed.select("id", S.utc_iso("last_conducted"))))
    assert iso == {
        "fiber-pre-2026": "2026-03-30T07:04:35+00:00",
        "fiber-before-created": "2026-03-30T07:04:35+00:00",
        "fiber-valid": "2026-04-01T00:00:00+00:00",
        "fiber-unused": None,
    }
    only, _ = lifecycle.repair(fibers, policy="pre2026", apply=True)
    assert only.filter(F.col("last_conducted") == F.col("created_at")).count() == 1
    with pytest.raises(ValueError):
        lifecycle.repair(fibers, policy="other")


def test_recency(spark):
    now = datetime(2026, 4, 4, tzinfo=UTC)
    rows = [(now - timedelta(days=1460), 0.8), (None, 0.5), (now - timedelta(hours=72), 0.1)]
    df = spark.createDataFrame(rows, "last timestamp, salience double")
    factors = [r[0] for r in df.select(S.recency_factor("last", "salience", F.lit(now))).collect()]
    assert factors == [0.1, 0.3 + 0.4 * 0.5, 0.5]


def test_top_n_of_a_hot_key_prunes_before_the_shuffle(spark, rows):
    # One key holds a third of all rows.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id"
    )
    plan = top_n(df, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")
    assert top_n(df, ["k"], ["id"], 2).filter("k = 0").count() == 2
    big = top_n(df, ["k"], ["id"], 999 + 1, "rank").filter("k = 0")
    assert rows(big.agg(F.count("*"), F.max("id"), F.max("rank"))) == [(1000, 2997, 1000)]


def test_positions_over_many_ranges(spark):
    df = spark.range(997).select(F.expr("(id * 7919) % 997").alias("key"))
    assert with_position(df, ["key"]).filter("position <> key").count() == 0


def brute_chunks(n, batch, max_rows):
    """File number of every row when batches are packed one after the other."""
    sizes = [batch] * (n // batch) + ([n % batch] if n % batch else [])
    result, file_no, used = [], 1, 0
    for size in sizes:
        if used and used + size > max_rows:
            file_no, used = file_no + 1, 0
        used += size
        result += [file_no] * size
    return result


@pytest.mark.parametrize(("n", "batch", "max_rows"), [(730, 100, 300), (650, 100, 350), (90, 100, 300), (310, 100, 60), (1000, 30, 100)])
def test_chunk_packing(spark, n, batch, max_rows):
    chunks = exchange.chunk_export(spark.range(n), ["id"], batch, max_rows).orderBy("id").collect()
    assert [r["file_no"] for r in chunks] == brute_chunks(n, batch, max_rows)
    assert [r["batch_no"] for r in chunks] == [i // batch + 1 for i in range(n)]


def test_sql_chunks_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(i, f"it's {i}", i % 2 == 0) for i in range(25)], "id bigint, name string, synced boolean")
    target = {"id": "bigint", "name": "text", "synced": "integer"}
    exchange.write_sql_chunks(df, "things", target, ["id"], str(tmp_path), batch=10, max_rows=20)
    parts = sorted(tmp_path.glob("table=things/part-*"))
    text = "".join(part.read_text() for part in parts)
    assert not list(tmp_path.glob("table=things/file_no=*")) and text.count("INSERT INTO") == 3
    chunks = text.split("-- chunk ")
    assert [c[:1] for c in chunks] == ["", "1", "2"] and [c.count("  (") for c in chunks] == [0, 20, 5]
    assert "  (1, 'it''s 1', FALSE)" in chunks[1]
    assert 'INSERT INTO "things" ("id", "name", "synced") VALUES' in chunks[2]


def test_files_follow_the_data_and_not_the_chunks(spark, tmp_path):
    df = spark.range(20_000).select("id", F.lit("x").alias("name"))
    exchange.write_sql_chunks(df, "many", {"id": "bigint", "name": "text"}, ["id"], str(tmp_path))
    parts = sorted(tmp_path.glob("table=many/part-*"))
    text = "".join(part.read_text() for part in parts)
    assert len(parts) <= 8 and text.count("-- chunk ") == 67
    ids = [int(line.strip()[1:].split(",")[0]) for line in text.splitlines() if line.startswith("  (")]
    assert ids == list(range(20_000))


def test_literals(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff'"), None, 1.5)], "raw binary, gone string, num double")
    target = {"raw": "text", "gone": "text", "num": "double precision"}
    assert exchange.insert_rows(df, target).head()["values_sql"] == "  ('a�''', NULL, 1.5)"


def test_reconcile(spark, rows):
    df = spark.createDataFrame([(1, "x", "y", "z")], "a int, b string, c string, d string")
    target = {"b": "text", "a": "bigint", "c": "ARRAY", "e": "text", "f": "USER-DEFINED"}
    common, report = exchange.reconcile(df, target)
    assert common.columns == ["a", "b"]
    assert rows(report) == [
        ("a", "common"), ("b", "common"), ("c", "skipped-type"), ("d", "source-only"), ("e", "target-only"),
    ]
    assert exchange.reconcile(df, {"z": "text"})[0] is None


def test_coercion(spark):
    texts = ["42", " 42 ", "3.7", "1_000", "1__0", "+7", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(S.to_int("t")).collect()] == [42, 42, None, 1000, None, 7, None, None, None]
    floats = ["1e3", " 2.5 ", ".5", "5.", "1.0d", "inf", "1_0.5", "", "-3"]
    df = spark.createDataFrame([(t,) for t in floats], "t string")
    assert [r[0] for r in df.select(S.to_float("t")).collect()] == [
        1000.0, 2.5, 0.5, 5.0, None, float("inf"), 10.5, None, -3.0,
    ]
    times = ["2025-01-15T10:30:00Z", "2025-01-15 10:30:00.123456+00:00", "2025-01-15", "2025", "10:30", "2025-01-15T12:30:00+02:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    assert [r[0] for r in df.select(S.utc_iso(S.to_ts("t"))).collect()] == [
        "2025-01-15T10:30:00+00:00", "2025-01-15T10:30:00.123456+00:00", "2025-01-15T00:00:00+00:00",
        None, None, "2025-01-15T10:30:00+00:00",
    ]


def test_metadata_patch_keeps_types(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [1, 2], "c": null}',), (None,)], "m string")
    patched = [json.loads(r[0]) for r in df.select(S.meta_patch("m", a="x", d=F.lit(2.5))).collect()]
    assert patched[0]["a"] == "x" and patched[0]["b"] == [1, 2] and patched[0]["d"] == 2.5
    assert patched[1] == {"a": "x", "d": 2.5}


def test_backup_and_versions(spark, tmp_path, rows):
    fibers = fibers_of(spark)
    path = exchange.write_backup(fibers, str(tmp_path), datetime(2026, 4, 4, 1, 2, 3))
    assert path.endswith("fibers-before-repair-2026-04-04-010203.json")
    assert spark.read.json(path).filter("id = 'fiber-valid'").head()["last_conducted"] == "2026-04-01T00:00:00+00:00"
    exchange.write_version({"fibers": fibers}, str(tmp_path / "store"), "1")
    back = exchange.read_version(spark, str(tmp_path / "store"), "1", ["fibers"])
    assert rows(back["fibers"]) == rows(fibers)


def test_load_is_idempotent_and_ordered(spark, rows):
    source = {
        "neurons": spark.createDataFrame([("b", "1", "x"), ("b", "1", "y"), ("b", None, "z")], "brain_id string, id string, content string"),
        "brains": spark.createDataFrame([("b",)], "id string"),
    }
    loaded, report = exchange.load_tables(source, {})
    assert [(r["table_name"], r["ok"], r["err"]) for r in report.orderBy("position").collect()] == [
        ("brains", 1, 0), ("neurons", 2, 1),
    ]
    assert rows(loaded["neurons"]) == [("b", "1", "x")]
    again, _ = exchange.load_tables(source, loaded, clear=False)
    assert rows(again["neurons"]) == rows(loaded["neurons"])
    status = exchange.verify_counts(source, loaded)
    assert rows(status, "table_name", "status") == [("brains", "OK"), ("neurons", "DIFF")]


def test_snapshots(spark, rows):
    store = {
        "brains": spark.createDataFrame([("a",), ("b",)], "id string"),
        "neurons": spark.createDataFrame([("a", "1"), ("b", "2")], "brain_id string, id string"),
    }
    snapshot = snapshots.export_brain(store, "a")
    merged = snapshots.import_brain(store, snapshot, "c")
    assert rows(merged["brains"]) == [("a",), ("b",), ("c",)]
    assert rows(merged["neurons"]) == [("a", "1"), ("b", "2"), ("c", "1")]
    same = snapshots.import_brain(store, snapshot)
    assert rows(same["neurons"]) == rows(store["neurons"])
    assert rows(snapshots.clear_brain(merged, "a")["neurons"]) == [("b", "2"), ("c", "1")]


def test_scan_rules(spark, rows):
    listing = [
        ("a.py", 10), ("b.GO", 10), ("c.ts", 2_000_000), ("node_modules/d.js", 10), ("x/.git/e.py", 10),
        ("vendors/f.py", 10), ("g.rs", 10), ("h.jsx", 10), ("z.php", 10), ("noext", 10),
    ]
    df = spark.createDataFrame([("/p", p, n, "") for p, n in listing], "project string, path string, length bigint, content string")
    assert rows(files.scan_files(df), "path") == [("a.py",), ("c.ts",), ("h.jsx",), ("vendors/f.py",)]
    assert rows(files.scan_files(df, max_size=1_000_000), "path") == [("a.py",), ("h.jsx",), ("vendors/f.py",)]
    assert rows(files.scan_files(df, exts=[".PY"], max_files=1), "path") == [("a.py",)]
    report, planned = files.scan_report(df, max_files=2, max_size=1_000_000)
    row = report.head()
    assert (row["outcome"], row["supported_files"], row["planned_languages"]) == ("ok", 2, ["go", "rust"])
    assert (row["truncated"], row["oversized_files"]) == (True, 1)
    assert rows(planned, "path") == [("b.GO",), ("g.rs",)]
    row = files.scan_report(df)[0].head()
    assert (row["supported_files"], row["planned_files"], row["truncated"], row["oversized_files"]) == (4, 3, False, 0)
    none = files.scan_report(df.filter("false"))[0].head()
    assert (none["outcome"], none["supported_files"], none["planned_languages"]) == ("error", 0, [])


def test_scans_have_no_limit_of_their_own(spark, rows):
    many = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "/a").otherwise("/b").alias("project"),
        F.format_string("d/%05d.py", "id").alias("path"), (F.col("id") * 1000).alias("length"), F.lit("").alias("content"),
    )
    assert files.scan_files(many).count() == 6000
    report, _ = files.scan_projects(many)
    assert rows(report, "project", "outcome", "supported_files", "truncated") == [("/a", "ok", 3000, False), ("/b", "ok", 3000, False)]
    report, _ = files.scan_projects(many, max_files=10, max_size=1_000_000)
    assert rows(report, "project", "supported_files", "truncated", "oversized_files") == [("/a", 10, True, 2499), ("/b", 10, True, 2500)]
    assert rows(files.scan_files(many, max_files=2), "project", "path") == [("/a", "d/00000.py"), ("/a", "d/00002.py"), ("/b", "d/00001.py"), ("/b", "d/00003.py")]


def test_tree_below_a_root_that_comes_again(spark, tmp_path, rows):
    deep = tmp_path / "x" / str(tmp_path).lstrip("/") / "y"
    deep.mkdir(parents=True)
    (deep / "a.py").write_text("z = 3\n")
    assert rows(files.read_tree(spark, str(tmp_path)), "path") == [(str(deep / "a.py")[len(str(tmp_path)) + 1 :],)]


def test_content_dedupe_with_nulls(spark, rows):
    """Null times, tenants and contents lose no content."""
    data = [("b", "x", None, "1"), ("b", "x", 5, "2"), ("b", "y", None, "3"), ("b", "y", None, "4"), (None, "x", 1, "5"), ("b", None, 2, "6"), ("b", None, 1, "7"), (None, "x", None, "8")]
    nodes = spark.createDataFrame(data, "brain_id string, content string, created_at int, id string")
    kept, groups = tables.dedupe_content(nodes)
    assert sorted(r["id"] for r in kept.collect()) == ["2", "3", "5", "7"] and kept.columns == nodes.columns
    assert groups.count() == 4 and groups.agg(F.sum("copies")).head()[0] == 8


def test_quarantine_keeps_every_bad_row(spark, rows, tmp_path):
    data = [(i, "7" if i % 3 else "x", "true" if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(data, "id int, n string, flag string").repartition(3)
    target = {"id": "bigint", "n": "integer", "flag": "boolean"}
    good, bad, report = exchange.load_with_quarantine(df, target, ["n", "flag"], ["id"], str(tmp_path / "load"))
    wrong = {i: ",".join(c for c, at in (("n", i % 3 == 0), ("flag", i % 5 == 0)) if at) for i in range(200)}
    wrong = {i: e for i, e in wrong.items() if e}
    assert {r["id"]: r["error"] for r in bad.collect()} == wrong
    assert {r["id"]: json.loads(r["raw"]).get("n") for r in bad.collect()} == {i: data[i][1] for i in wrong}
    assert sorted(r["id"] for r in good.collect()) == sorted(set(range(200)) - set(wrong))
    assert tuple(report.head()) == (200 - len(wrong), len(wrong))
    assert rows(exchange.first_errors(bad, ["id"])) == [(0, "n,flag"), (3, "n"), (5, "flag")]
    # one pass: both parts are folders of one table
    assert sorted(p.name for p in (tmp_path / "load").iterdir() if p.is_dir()) == ["__bad=false", "__bad=true"]
    empty = exchange.load_with_quarantine(df.filter("false"), target, ["n"], ["id"])
    assert empty[0].count() == empty[1].count() == 0 and tuple(empty[2].head()) == (0, 0)


def test_counts_of_absent_tables(spark, rows):
    two, three = spark.range(2), spark.range(3)
    found = exchange.verify_counts({"a": two, "gone": three, "none": two.filter("false")}, {"a": three, "new": two})
    assert rows(found) == [("a", 2, 3, "OK"), ("gone", 3, 0, "DIFF"), ("new", 0, 2, "OK"), ("none", 0, 0, "DIFF")]


def test_read_tree(spark, tmp_path, rows):
    (tmp_path / "pkg").mkdir()
    (tmp_path / "pkg" / "a.py").write_text("x = 1\n")
    (tmp_path / "b.py").write_text("y = 2\n")
    tree = files.read_tree(spark, str(tmp_path), "/proj")
    assert rows(tree) == [("/proj", "b.py", 6, "y = 2\n"), ("/proj", "pkg/a.py", 6, "x = 1\n")]


def test_merge_of_equal_snapshots_changes_nothing(spark, rows):
    snap = spark.createDataFrame([("1", "x", 0.5, 10), ("2", None, 0.1, 11)], "id string, content string, weight double, updated_at int")
    for strategy in tables.MERGE_STRATEGIES:
        merged, report = tables.merge_snapshots(snap, snap, strategy)
        assert rows(merged) == rows(snap)
        assert tuple(report.head()) == (0, 0, 2, 0)
    with pytest.raises(ValueError):
        tables.merge_snapshots(snap, snap, "other")


def test_cascade_delete_follows_all_references(spark, rows):
    store = {
        "brains": spark.createDataFrame([("b",), ("c",)], "id string"),
        "neurons": spark.createDataFrame([("b", "1"), ("b", "2"), ("c", "1")], "brain_id string, id string"),
        "synapses": spark.createDataFrame([("b", "s", "1", "2"), ("b", "t", "2", "2"), ("c", "u", "1", "1")], "brain_id string, id string, source_id string, target_id string"),
        "fibers": spark.createDataFrame([("b", "f")], "brain_id string, id string"),
        "fiber_neurons": spark.createDataFrame([("b", "f", "1"), ("b", "f", "2")], "brain_id string, fiber_id string, neuron_id string"),
    }
    gone = spark.createDataFrame([("b", "1")], "brain_id string, id string")
    left = lifecycle.cascade_delete(store, "neurons", gone)
    assert rows(left["synapses"], "id") == [("t",), ("u",)]
    assert rows(left["fiber_neurons"], "neuron_id") == [("2",)]
    assert left["fibers"].count() == 1 and left["brains"].count() == 2
    left = lifecycle.cascade_delete(store, "brains", store["brains"].filter("id = 'b'"))
    assert {name: frame.count() for name, frame in left.items()} == {
        "brains": 1, "neurons": 1, "synapses": 1, "fibers": 0, "fiber_neurons": 0,
    }


def test_checks(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "active")], "id string, status string")
    assert rows(checks.pk_violations(df, ["id"])) == [("a", 2)]
    assert rows(checks.enum_violations(df, "status")) == [("a", "x")]
    assert rows(checks.null_counts(df, ["id", "status"])) == [("id", 0), ("status", 1)]
    parent = spark.createDataFrame([("x",)], "key string")
    assert rows(checks.orphans(df, parent, {"status": "key"})) == [("b", "active")]
    filled = checks.fill_defaults(df, {"status": ("string", "active"), "n": ("int", 5)})
    assert rows(filled) == [("a", "x", 5), ("a", None, 5), ("b", "active", 5)]


def test_active_symbols_three_ways(spark, rows):
    nodes = spark.createDataFrame([("1", "g1", "/p"), ("2", "g2", "/p"), ("3", "g3", "/q")], "id string, generation_id string, project_path string")
    schema = "generation_id string, project_path string, status string"
    none = spark.createDataFrame([], schema)
    assert search.active_symbols(nodes, none).count() == 3
    failed = spark.createDataFrame([("g1", "/p", "failed")], schema)
    assert search.active_symbols(nodes, failed).count() == 0
    assert rows(search.active_symbols(nodes, failed, "/q"), "id") == [("3",)]
    some = spark.createDataFrame([("g1", "/p", "gc"), ("g2", "/p", "active")], schema)
    assert rows(search.active_symbols(nodes, some), "id") == [("2",)]


def test_text_search(spark, rows):
    docs = spark.createDataFrame([("1", "The Éclair, the pie!"), ("2", "pie chart"), ("3", "")], "id string, content string")
    assert rows(search.text_match(docs, "PIE the"), "id") == [("1",), ("2",)]
    assert rows(search.text_match(docs, "éclair pie"), "id") == [("1",)]
    assert search.text_match(docs, "the").count() == 0


def test_text_index(spark, rows, tmp_path):
    """Lists of any length in bounded blocks, ranges that share no document, repeated and nameless documents."""
    docs = [(i, " ".join(w for n, w in ((1, "hot"), (3, "three"), (5, "Five"), (50, "rare")) if i % n == 0)) for i in range(1000)]
    docs += [(7, "hot"), (10**12, "hot far"), (10**12 + 1, "five"), (None, "hot five"), (2000, None), (2001, ""), (2002, "the")]
    frame = spark.createDataFrame(docs, "id bigint, content string").repartition(4)
    blocks = search.posting_blocks(frame, span=64).cache()
    held = {}
    for i, text in docs:
        for w in set((text or "").lower().split()) - {"the"}:
            if i is not None:
                held.setdefault(w, set()).add(i)
    assert sorted(tuple(r) for r in search.block_ids(blocks).collect()) == sorted((w, i) for w, ids in held.items() for i in ids)
    assert blocks.filter("n > 64 or first_id div 64 <> last_id div 64").count() == 0
    found = {r["token"]: (r["df"], r["first_id"], r["last_id"]) for r in search.token_frequencies(blocks).collect()}
    assert found == {w: (len(ids), min(ids), max(ids)) for w, ids in held.items()}
    for question in ("HOT", "three five", "hot three, Five the", "rare three", "far five", "hot nowhere", "the", ""):
        words = set(question.lower().replace(",", " ").split()) - {"the"}
        want = set.intersection(*[held.get(w, set()) for w in words]) if words else set()
        assert {r["id"] for r in search.match_blocks(blocks, question).collect()} == want
    # a stored index is read by token and never by text
    blocks.write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    plan = search.match_blocks(stored, "three five")._jdf.queryExecution().toString()
    assert "split(" not in plan and "PushedFilters: [In(token, [five,three])" in plan
    names = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", "z"), (None, "w")], "id string, content string")
    assert rows(search.numbered(names), "id", "doc_no") == [("a", 0), ("b", 1)]


def test_nodes_by_page(spark):
    nodes = spark.createDataFrame([(f"n{i:03d}", "T", "text") for i in range(250)], "id string, type string, content string")
    assert search.find_nodes(nodes).count() == 250
    pages, last = [], None
    while True:
        page = [r["id"] for r in search.find_nodes(nodes, limit=60, after=last).collect()]
        if not page:
            break
        pages += page
        last = page[-1]
    assert pages == [f"n{i:03d}" for i in range(250)]


def brute_knn(vectors_, queries, k):
    def unit(m):
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    scores = unit(queries) @ unit(vectors_).T
    return [[int(i) for i in np.lexsort((np.arange(len(vectors_)), -row))[:k]] for row in scores]


def test_knn_in_blocks_against_numpy(spark):
    rng = np.random.default_rng(3)
    stored, asked = rng.normal(size=(300, 8)), rng.normal(size=(23, 8))
    schema = "id bigint, embedding array<double>"
    vectors_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(stored)], schema).repartition(5)
    queries_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], schema)
    want = brute_knn(stored, asked, 7)
    for block in (2048, 10):
        found = vectors.knn(vectors_df, queries_df, 7, block).orderBy("query_id", "rank").collect()
        assert [[r["id"] for r in found if r["query_id"] == q] for q in range(23)] == want
    centroids = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(stored[:6])], "list_id bigint, embedding array<double>")
    all_lists = vectors.knn_lists(vectors_df, queries_df, 7, centroids, probes=6)
    got = all_lists.orderBy("query_id", "rank").collect()
    assert [[r["id"] for r in got if r["query_id"] == q] for q in range(23)] == want
    few = vectors.knn_lists(vectors_df, queries_df, 7, centroids, probes=3).collect()
    hits = sum(r["id"] in want[r["query_id"]] for r in few)
    assert hits / (23 * 7) > 0.6


def test_knn_in_rounds_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROUND_BYTES", 2000)
    rng = np.random.default_rng(5)
    stored, asked = rng.normal(size=(200, 6)), rng.normal(size=(60, 6))
    schema = "id bigint, embedding array<double>"
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [1.0] * 5), (903, []), (None, [1.0] * 6), (904, [0.0] * 6)]
    vectors_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(stored)] + odd, schema).repartition(3)
    queries_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)] + odd[:4], schema)
    assert len(vectors._rounds(vectors.packed(queries_df, 8))) > 2
    found = vectors.knn(vectors_df, queries_df.filter("id < 900"), 5, 8).collect()
    want = brute_knn(stored, asked, 5)
    got = {q: [r["id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in range(60)}
    assert all(got[q] == want[q] for q in range(60))
    # queries of another length meet vectors of that length only
    assert [r["id"] for r in vectors.knn(vectors_df, queries_df.filter("id = 902"), 5).collect()] == [902]
    assert vectors.knn(vectors_df, queries_df.filter("id in (900, 901, 903)"), 5).count() == 0
    centroids = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(stored[:40])], "list_id bigint, embedding array<double>")
    listed = {r["id"]: r["list_id"] for r in vectors.assign_lists(vectors_df, centroids).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    best = (unit(stored) @ unit(stored[:40]).T).argmax(axis=1)
    assert all(listed[i] == best[i] for i in range(200))


def test_inverted_file_reads_only_probed_lists(spark, tmp_path):
    """Recall against the exact search, work that falls with the probes, and a list with a third of all vectors."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(24, 16))
    label = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 24, 3000))
    data = centers[label] + 0.25 * rng.normal(size=(3000, 16))
    schema = "id bigint, embedding array<double>"
    vectors_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], schema).repartition(4)
    queries_df = vectors_df.filter("id % 40 = 0")
    centroids = vectors.train_centroids(vectors_df, 24, sample=1000, rounds=3)
    listed = vectors.assign_lists(vectors_df, centroids)
    path = str(tmp_path / "lists")
    vectors.list_blocks(listed, block=100).write.parquet(path)
    blocks = spark.read.parquet(path)
    sizes = {r["list_id"]: r["n"] for r in listed.groupBy("list_id").count().withColumnRenamed("count", "n").collect()}
    stored_sizes = {r["list_id"]: (r["n"], r["m"]) for r in blocks.groupBy("list_id").agg(F.sum("n").alias("n"), F.max("n").alias("m")).collect()}
    assert {k: n for k, (n, _) in stored_sizes.items()} == sizes and max(m for _, m in stored_sizes.values()) <= 100
    exact = {(r["query_id"], r["id"]) for r in vectors.knn(vectors_df, queries_df, 5).collect()}
    read = {}
    for probes in (1, 4, 24):
        found = {(r["query_id"], r["id"]) for r in vectors.probe_lists(blocks, queries_df, centroids, 5, probes).collect()}
        probed = vectors._nearest_lists(queries_df, "id", centroids, probes)
        read[probes] = sum(sizes.get(r["list_id"], 0) for r in probed.collect())
        if probes >= 4:
            assert len(found & exact) >= 0.9 * len(exact)
    assert found == exact and read[1] < read[4] < read[24] / 2
    plan = vectors.probe_lists(blocks, queries_df, centroids, 5, 4)._jdf.queryExecution().toString()
    assert "list_id" in plan and "NestedLoop" not in plan


def test_change_feed_retries_and_deletes(spark, tmp_path, rows):
    rng = random.Random(7)
    records = [(i, f"k{rng.randrange(8)}", rng.choice(["add", "update", "delete"]), i * 1.0) for i in range(60)]
    schema = "seq bigint, key string, op string, value double"
    source = tmp_path / "in"
    for part in range(3):
        piece = records[part * 20 : part * 20 + 20]
        spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        changes.apply_changes(stream, str(tmp_path / "log"), str(tmp_path / "offsets")).awaitTermination()

    run()
    state = {}
    for _, key, op, value in records:
        if op == "delete":
            state.pop(key, None)
        else:
            state[key] = value
    log = changes.current_log(spark, str(tmp_path / "log"))
    assert dict(rows(changes.current_rows(log), "key", "value")) == state
    deltas = sorted((tmp_path / "log" / "deltas").glob("epoch=*/batch=*"))
    assert [d.name for d in deltas] == [f"batch={i:012d}" for i in range(3)]
    run()  # nothing new, nothing changes
    assert dict(rows(changes.current_rows(log), "key", "value")) == state
    # A batch that is written again replaces itself.
    last = spark.read.parquet(str(deltas[2]))
    kept = rows(last)
    changes.latest_changes(spark.createDataFrame(last.collect(), last.schema)).write.mode("overwrite").parquet(str(deltas[2]))
    assert rows(spark.read.parquet(str(deltas[2]))) == kept
    assert changes.compact(spark, str(tmp_path / "log")) == 1
    assert dict(rows(changes.current_rows(changes.current_log(spark, str(tmp_path / "log"))), "key", "value")) == state


def test_change_feed_goes_on_after_folds_and_new_checkpoints(spark, tmp_path, rows):
    """Every order of batches, folds and restarts leaves the state of all changes, and no folded batch is read again."""
    schema = "seq bigint, key string, op string, value double"
    log, source = str(tmp_path / "log"), tmp_path / "in"
    rng = random.Random(3)
    state, seq = {}, 0
    with pytest.raises(FileNotFoundError):
        changes.current_log(spark, log)
    for turn in range(6):
        for _ in range(2):
            piece = []
            for _ in range(10):
                seq += 1
                piece.append((seq, f"k{rng.randrange(9)}", rng.choice(["add", "update", "delete"]), float(seq)))
            for _, key, op, value in piece:
                if op == "delete":
                    state.pop(key, None)
                else:
                    state[key] = value
            spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(str(source / f"t{turn // 2}"))
        # turns 0 and 1 share a checkpoint, 2 and 3 begin a new one, and so on
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source / f"t{turn // 2}"))
        changes.apply_changes(stream, log, str(tmp_path / f"offsets{turn // 2}")).awaitTermination()
        assert dict(rows(changes.current_rows(changes.current_log(spark, log)), "key", "value")) == state
        if turn in (1, 2, 4):
            assert changes.compact(spark, log) == {1: 1, 2: 2, 4: 3}[turn]
            assert dict(rows(changes.current_rows(changes.current_log(spark, log)), "key", "value")) == state
    assert len(list((tmp_path / "log" / "deltas").glob("epoch=*"))) == 3
    held = changes.manifest(spark, log).collect()
    assert {r["version"] for r in held} == {3} and len(held) == 3
    # a fold that stopped before its manifest changes nothing
    spark.createDataFrame([(99, "bad", "add", 1.0, None)], f"{schema}, deleted_seq bigint").write.parquet(f"{log}/base/version=4")
    assert dict(rows(changes.current_rows(changes.current_log(spark, log)), "key", "value")) == state


def test_edges_do_not_survive_a_delete(spark, rows):
    feed = spark.createDataFrame(
        [(1, "a", "add", 0.0), (2, "b", "add", 0.0), (4, "a", "delete", 0.0), (5, "a", "add", 0.0)],
        "seq bigint, key string, op string, value double",
    )
    log = changes.latest_changes(feed)
    edges = spark.createDataFrame([("a", "b", 3), ("a", "b", 6), ("b", "c", 7)], "src string, dst string, seq bigint")
    assert rows(changes.live_edges(edges, log)) == [("a", "b", 6)]
