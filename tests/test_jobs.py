"""Whole runs: migration, repair, two-store sync."""

from datetime import UTC, datetime

from cairngraph.plans.exchange_jobs import migrate, run_repair, sync, sync_stores


def test_migrate(spark, rows):
    source = {
        "brains": spark.createDataFrame(
            [("b", "B", "{}", "1", "2026-01-01T00:00:00Z", "2026-01-01", "old")],
            "id string, name string, config string, is_public string, created_at string, "
            "updated_at string, legacy string",
        ),
        "neurons": spark.createDataFrame(
            [
                ("1", "b", "fact", bytearray(b"text"), "7", "2026-01-01 10:00:00"),
                ("2", "b", "fact", bytearray(b"\xff"), "x", "2026-01-01"),
                ("3", "b", "fact", bytearray(b"late"), "1", "soon"),
                ("2", "b", "fact", bytearray(b"again"), "8", "2026-01-01"),
            ],
            "id string, brain_id string, type string, content binary, content_hash string, "
            "created_at string",
        ),
        "fibers": spark.createDataFrame([], "id string, brain_id string"),
        "unknown": spark.createDataFrame([("x",)], "id string"),
    }
    catalog = {
        "brains": {
            "id": "text", "name": "text", "config": "jsonb", "is_public": "boolean",
            "created_at": "timestamp with time zone", "updated_at": "timestamp with time zone",
        },
        "neurons": {
            "id": "text", "brain_id": "text", "type": "text", "content": "text",
            "content_hash": "bigint", "embedding": "USER-DEFINED",
            "created_at": "timestamp with time zone",
        },
        "fibers": {"id": "text", "brain_id": "text"},
    }
    loaded, report, errors = migrate(source, catalog)
    assert sorted(loaded) == ["brains", "neurons"]
    assert rows(report, "table_name", "ok", "err", "status") == [
        ("brains", 1, 0, "OK"),
        ("neurons", 3, 1, "DIFF"),
    ]
    assert rows(errors, "table_name", "key", "error") == [("neurons", "b:3", "created_at")]
    assert rows(loaded["brains"], "id", "is_public") == [("b", True)]
    assert rows(loaded["neurons"], "id", "content", "content_hash") == [
        ("1", "text", 7),
        ("2", "again", 8),
    ]


def test_run_repair(spark, rows, tmp_path):
    created = datetime(2026, 3, 30, tzinfo=UTC)
    old = datetime(2022, 1, 1, tzinfo=UTC)
    fibers = spark.createDataFrame(
        [("f", "a", created, old), ("f", "b", created, old), ("g", "a", created, None)],
        "id string, brain_id string, created_at timestamp, last_conducted timestamp",
    )
    same, summary, samples = run_repair(fibers, "a")
    assert same is fibers and (summary["candidate_count"], summary["updated_count"]) == (1, 0)
    assert rows(samples, "id", "reason") == [("f", "pre2026")]
    fixed, summary, _ = run_repair(fibers, "a", apply=True, backup_dir=str(tmp_path))
    assert summary["updated_count"] == 1
    assert spark.read.json(summary["backup_path"]).count() == 1
    changed = fixed.filter("last_conducted = created_at")
    assert rows(changed, "id", "brain_id") == [("f", "a")]
    assert fixed.count() == 3
    _, summary, _ = run_repair(fixed, "a", apply=True, backup_dir=str(tmp_path))
    assert summary["backup_path"] is None


def test_sync_stores(spark, rows):
    schema = "id string, brain_id string, source_id string, weight double"
    local = {"synapses": spark.createDataFrame([("1", "b", "x", 0.2), ("2", "b", "x", 0.9), ("9", "c", "x", 1.0)], schema)}
    remote = {"synapses": spark.createDataFrame([("1", "b", "y", 0.7), ("2", "b", "y", 0.1), ("3", "b", "z", 0.5)], schema)}
    merged, report = sync_stores(local, remote, "b", "prefer_stronger")
    assert rows(merged["synapses"], "id", "source_id") == [("1", "y"), ("2", "x"), ("3", "z")]
    row = report.head()
    assert (row["added"], row["updated"], row["skipped"], row["conflicts"]) == (1, 1, 1, 2)
    pushed, report = sync_stores(local, None, "b")
    assert report is None and pushed["synapses"].count() == 2


def test_sync_leaves_both_stores_alike(spark, rows):
    schema = "id string, brain_id string, source_id string, weight double"
    local = {"synapses": spark.createDataFrame([("1", "b", "x", 0.2), ("2", "b", "x", 0.9), ("9", "c", "x", 1.0)], schema)}
    remote = {"synapses": spark.createDataFrame([("1", "b", "y", 0.7), ("3", "b", "z", 0.5), ("1", "d", "q", 0.1)], schema)}
    ours, theirs, report = sync(local, remote, "b", "prefer_stronger")
    merged = [("b", "1", "y"), ("b", "2", "x"), ("b", "3", "z")]
    assert rows(ours["synapses"], "brain_id", "id", "source_id") == [*merged, ("c", "9", "x")]
    assert rows(theirs["synapses"], "brain_id", "id", "source_id") == [*merged, ("d", "1", "q")]
    assert rows(report) == [("synapses", 1, 1, 0, 1, True, True)]
    ours, theirs, report = sync(local, None, "b")
    assert ours["synapses"].count() == 3 and theirs["synapses"].count() == 2
    assert (report.head()["pulled"], report.head()["pushed"]) == (False, True)
