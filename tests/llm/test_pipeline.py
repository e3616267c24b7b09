"""The pipeline and its stages on odd rows and on the small tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stage_takes_odd_rows(spark, stage):
    name, run = stage
    empty = spark.createDataFrame([], DOCS)
    assert run(spark, empty, SF).count() == 0
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "a b c", "en", "x", 5), (1, "a b c", "en", "x", 5), (2, None, None, None, None), (3, "", "de", "x", 0), (None, "a", "en", "x", 1), (4, long, "en", "x", 1)]
    out = run(spark, spark.createDataFrame(rows, DOCS), SF)
    ids = [r.doc_id for r in out.select("doc_id").distinct().collect()]
    assert set(ids) >= {1, 2, 3, 4, None}
    if name != "packing":
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        more = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("_id", "_n", "_r", "doc", "score", "more", "keys", "component_id")})
        wide = run(spark, more, SF)
        assert wide.columns == more.columns and wide.count() == out.count()
        # the further columns come back as they were
        more = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(77) for c in ("_id", "_n", "_r", "r", "row", "d", "x", "perhaps", "_bits")})
        assert {tuple(r)[5:] for r in run(spark, more, SF).collect()} == {(77,) * 9}


def test_pipeline_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SF)
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert tokens.filter("n <> m").count() == 0
    kept = {r.doc_id for r in tokens.collect()}
    assert kept < {r.doc_id for r in docs.select("doc_id").collect()} and len(kept) > 150


def test_near_copies_leave_the_least_id(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(5, base, "en", "x", 1), (3, base + " z", "en", "x", 1), (9, base, "en", "y", 1), (4, "other text", "en", "x", 1)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), SF)
    assert sorted(r.doc_id for r in out.collect()) == [3, 4]


def test_passages_are_cut_once(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    rows = [(1, f"one  {passage} two", "en", "x", 1), (2, f"three {passage} four", "en", "x", 1)]
    out = {r.doc_id: r.text for r in corpus_pipeline.cut_passages(spark, spark.createDataFrame(rows, DOCS), SF).collect()}
    assert out == {1: f"one  {passage} two", 2: "three four"}


def test_near_copies_of_rows_that_share_an_id(spark):
    base, own = (" ".join(f"{c}{i}" for i in range(100)) for c in "wv")
    rows = [(1, base, "en", "x", 1), (2, base + " z", "en", "x", 1), (2, own, "en", "x", 1), (2, own + " z", "en", "x", 1), (None, base, "en", "x", 1)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), SF)
    kept = sorted((r.doc_id or 0, r.text.split()[0]) for r in out.collect())
    assert kept == [(0, "w0"), (1, "w0"), (2, "v0")]
