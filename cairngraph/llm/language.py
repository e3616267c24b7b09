"""Language identification by nearest centroids of TF-IDF character n-grams.

A text's letters, lower-cased, with everything else as a blank, give n-grams of one to three characters, hashed into a
fixed number of features. Document frequencies come from all learnable rows. Of every language a bounded sample is clustered
into a few centroids by spherical k-means. A text gets the language of the centroid of greatest cosine; it is also
marked as rejected if that cosine is lower than nearly all of the sample had with their own centroid.

The model is `languages` x `clusters` vectors of `FEATURES` floats, which travels with the tasks. Scoring maps the scan;
training shuffles one count per feature and task, and the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import hash_sample, part, texts
from cairngraph.llm.registry import query, table

FEATURES = 4096
SAMPLE = 400  # labelled rows per language that the centroids are fitted on
BROADCAST_ROWS = 50_000
CHUNK = 400_000  # characters per vectorised step
ROWS = 256  # and rows


def letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def chunked(docs: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for text in docs:
        if held and (size + len(text) > CHUNK or len(held) >= ROWS):
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def counts(docs: list[str], letter: np.ndarray) -> np.ndarray:
    """n-gram counts, documents x features."""
    lower = [t.lower() for t in docs]
    # every text ends in a blank, the last one, too
    codes = np.frombuffer("".join(t + "\x00" for t in lower).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(docs)), [len(t) + 1 for t in lower])
    is_letter = letter[codes]
    codes = np.where(is_letter, codes, 32)
    found = np.zeros(len(docs) * FEATURES, np.int64)
    gram, some = codes, is_letter
    for n in range(1, 4):
        if n > 1:
            gram = gram[:-1] * 0x110000 + codes[n - 1 :] if n == 2 else gram[:-1] * 31 + codes[n - 1 :] * 0x9E3779B1
            some = some[:-1] | is_letter[n - 1 :]
        inside = some & (doc[: len(gram)] == doc[n - 1 :])
        h = gram[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(52)
        found += np.bincount(doc[: len(gram)][inside] * FEATURES + h.astype(np.int64), minlength=len(found))
    return found.reshape(len(docs), FEATURES)


def weigh(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of log(1 + tf) * idf; a row without n-grams stays zero."""
    x = np.log1p(found.astype(np.float32)) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letter, total, rows = letters(), np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for some in chunked(batch.column("text").to_pylist()):
            present = counts(some, letter) > 0
            total += present.sum(0)
            rows += int(present.any(1).sum())
    yield pa.record_batch({"feature": np.arange(-1, FEATURES), "n": np.append(rows, total)})


def _clusters(idf: np.ndarray, clusters: int, quantile: float):
    """Spherical k-means of one language's sample, started from the farthest points."""

    def run(group: pa.Table) -> pa.Table:
        letter = letters()
        order = np.argsort(group.column("doc_id").to_numpy(), kind="stable")
        docs = [group.column("text")[int(i)].as_py() for i in order]
        x = np.concatenate([weigh(counts(some, letter), idf) for some in chunked(docs)])
        x = x[x.any(1)]
        if not len(x):  # no letter in the whole sample: nothing to be near to
            return pa.table({"lang": pa.array([], pa.string()), "least": pa.array([], pa.float64()), "center": pa.array([], pa.binary())})
        centers = x[:1]
        for _ in range(clusters - 1):
            near = (x @ centers.T).max(1)
            if near.min() > 1 - 1e-6:
                break
            centers = np.concatenate([centers, x[near.argmin()][None]])
        for _ in range(12):
            own = (x @ centers.T).argmax(1)
            sums = np.stack([x[own == c].sum(0) if (own == c).any() else centers[c] for c in range(len(centers))])
            centers = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)
        score = x @ centers.T
        own = score.argmax(1)
        least = [float(np.quantile(score[own == c, c], quantile)) if (own == c).any() else 1.0 for c in range(len(centers))]
        return pa.table(
            {
                "lang": pa.array([group.column("lang")[0].as_py()] * len(centers), pa.string()),
                "least": pa.array(least, pa.float64()),
                "center": pa.array([c.astype("<f4").tobytes() for c in centers], pa.binary()),
            }
        )

    return run


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], least: np.ndarray, centers: np.ndarray):
        self.idf, self.langs, self.least, self.centers = idf, langs, least, centers


def fit(learnable: DataFrame, clusters: int = 4, sample: int = SAMPLE, quantile: float = 0.01) -> Model:
    """A model of rows (`doc_id`, `text`, `lang`); null texts and languages are left out."""
    rows = learnable.select(*texts(learnable), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang is not null and text is not null")
    found = rows.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    per = {r["feature"]: r["n"] for r in found.collect()}  # one row per feature
    n = per.get(-1, 0)
    df = np.array([per.get(f, 0) for f in range(FEATURES)], np.float64)
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    chosen = hash_sample(rows.filter("doc_id is not null").select("doc_id", "lang"), "lang", ["doc_id"], F.lit(sample))
    chosen = chosen.select("doc_id", F.col("lang").alias("l")).distinct()
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    picked = rows.join(chosen.withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("lang") == F.col("l")))
    groups = picked.select("doc_id", "lang", "text").groupBy("lang")
    centers = groups.applyInArrow(_clusters(idf, clusters, quantile), "lang string, least double, center binary")
    centers = centers.orderBy("lang", "center").collect()  # languages x clusters rows
    vectors = np.array([np.frombuffer(r["center"], "<f4") for r in centers]).reshape(-1, FEATURES)
    return Model(idf, [r["lang"] for r in centers], np.array([r["least"] for r in centers]), vectors)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `lang_pred`, `score` (cosine, 0 to 1) and `rejected`, from `text` alone."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters()
        langs = np.array([*model.langs, "und"], object)
        for batch in batches:
            which, scores = [], []
            for some in chunked([t or "" for t in batch.column("text").to_pylist()]):
                x = weigh(counts(some, letter), model.idf)
                s = x @ model.centers.T if len(model.centers) else np.zeros((len(some), 1), np.float32)
                top = s.argmax(1)
                top[~x.any(1) | (len(model.centers) == 0)] = len(langs) - 1
                which.append(top)
                scores.append(np.where(top < len(langs) - 1, s.max(1), 0.0))
            top, score = np.concatenate(which), np.clip(np.concatenate(scores), 0.0, 1.0).astype(np.float64)
            far = score < np.append(model.least, 2.0)[top]
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs[top], pa.string()), pa.array(score), pa.array(far)], [*keep, "lang_pred", "score", "rejected"]
            )

    chosen = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in keep])
    return chosen.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Prediction for every document by a model of those whose fold (crc32 of the id as text, modulo 3) is not 1.

    `doc_id`, `held_out`, `lang_pred`, `score`, `rejected`. Null texts and texts without a letter are `und` with score 0 and
    rejected, as are all if nothing can be learned. Rows with a null id are predicted, not learned from; their `held_out`
    is false. A language none of whose learnable texts has a letter is never predicted. Repeated rows are predicted alike, of
    languages equally near the first in order counts, and texts of any length are read whole. An empty table gives no row;
    other columns are ignored.
    """
    fold = part("doc_id", 3)
    model = fit(docs.select("doc_id", "text", "lang").filter(fold != 1))
    held = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return predict(docs.select(*texts(docs)).select("doc_id", held, "text"), model).drop("text")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
