"""The corpus pipeline: toxicity, near duplicates, repeated passages, secrets, packing.

Each stage takes `(spark, docs, sf_dir)` and returns a DataFrame, which is written as Parquet and read again as the next
stage's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cairngraph.llm import jaccard, packing, secrets, substring, toxicity
from cairngraph.llm.common import part
from cairngraph.llm.registry import table
from cairngraph.session import shared_dir

# Stages hand texts to Python in batches of at most so many bytes, so that a task's memory does not follow the length of its rows.
BATCH_BYTES = str(16 << 20)
PASSAGE_WORDS = 50  # a passage of so many words that a document with a smaller id has, too, is cut


def in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not call toxic. It learns from the labels of fold crc32(doc_id) mod 5 other than 0.

    Null and empty texts are not toxic and rows without an id are scored like others; columns of any name are kept.
    """
    in_small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(part("doc_id", 5) != 0))
    scored = toxicity.score(docs, model)
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by the similarity of 5-word shingles (0.8 or more): the one of least id.

    Null and empty texts are near to nothing and stay, as do rows without an id; an empty table gives no row.
    """
    in_small_batches(spark)
    return jaccard.drop_near_copies(docs, n=5, percent=80)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of `PASSAGE_WORDS` words and more that a document of smaller id has, too.

    Texts without such a passage stay as they are; of others the kept words remain, with one blank between them.
    """
    in_small_batches(spark)
    found = substring.remove_repeats(docs, size=PASSAGE_WORDS, anchor=12, untouched=True)
    return found.withColumnRenamed("kept_text", "text").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret.

    Null and empty texts hold none, rows without an id are cleaned like others, and columns of any name are kept.
    """
    in_small_batches(spark)
    return secrets.redact(docs, secrets.scan(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens; a null or empty text is one piece of the closing id alone."""
    import public_tokenizers

    in_small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]
ORACLE_SQL = None  # learned and tokenising stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what is between them lies in the shared folder."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
