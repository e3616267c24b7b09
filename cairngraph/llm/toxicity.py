"""Toxicity by multiple-instance learning: documents carry labels, sentences carry the evidence.

A sentence's probability is logistic in the telling words it holds; a sentence without any is no evidence, so length alone
makes no document suspect. A document's probability is the noisy-or of its sentences and of a small leak for wrong labels,
1 - (1 - leak) * prod(1 - p): one offending sentence is enough, and a document's label trains the sentences in it. With
A = sum of softplus(z) over sentences and leak, the loss is A for a clean document and -log(1 - exp(-A)) for a toxic one,
and dA/dz is the sentence's probability.

The model is fitted on a bounded sample of labelled documents, in one task; its words are those whose documents differ
between the labels beyond chance among so many words. Scoring maps the scan, and returns the offending sentences besides.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import hash_sample, part, texts
from cairngraph.llm.registry import query, table

SAMPLE = {1: 4000, 0: 6000}  # labelled documents of each kind that the model is fitted on
MOST_CHARS = 200_000  # longer texts are scored like others, but not learned from
WORDS = 400
ROUNDS = 600
SENTENCE = r"[^.!?\n]+"
WORD = r"[^\W\d_]+"


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-cased words of every sentence that has one."""
    for m in re.finditer(SENTENCE, text):
        found = re.findall(WORD, m[0].lower())
        if found:
            yield m.start(), m.end(), found


def vocabulary(docs: list[list[list[str]]], labels: np.ndarray, size: int) -> list[str]:
    """The words whose documents differ most between the labels, by the likelihood ratio, and beyond chance among all."""
    seen = [Counter(), Counter()]
    for doc, y in zip(docs, labels.tolist(), strict=True):
        seen[y].update({w for s in doc for w in s})
    n = [int((labels == y).sum()) for y in (0, 1)]
    share = n[1] / max(1, sum(n))
    ranked = []
    for w in sorted(seen[0] | seen[1]):
        a, b = seen[0][w], seen[1][w]
        if a + b >= 3 and 0 < share < 1:
            ratio = sum(k * math.log(k / ((a + b) * p)) for k, p in ((a, 1 - share), (b, share)) if k)
            ranked.append((-2 * ratio, w))
    least = 2 * math.log(max(2, len(ranked)))
    return [w for r, w in sorted(ranked)[:size] if -r > least]


def train(docs: list[list[list[str]]], labels: np.ndarray, size: int = WORDS, rounds: int = ROUNDS) -> dict[str, float]:
    """Weight of each telling word; under "" that of every sentence with one, under " " that of the leak."""
    words = vocabulary(docs, labels, size)
    index = {w: k for k, w in enumerate(words)}
    known = index.keys()
    owner, row, column = [], [], []
    for d, doc in enumerate(docs):
        for sentence in doc:
            if not known.isdisjoint(sentence):
                found = [index[w] for w in sentence if w in known]
                row += [len(owner)] * len(found)
                column += found
                owner.append(d)
    owner, row, column = (np.array(x, np.int64) for x in (owner, row, column))
    k = len(words)
    w = np.zeros(k + 2)  # words, sentence, leak
    w[k:] = -1.0, -3.0
    m, v = np.zeros(k + 2), np.zeros(k + 2)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, rounds + 1):
        z = w[k] + np.bincount(row, w[column], len(owner))
        total = np.bincount(owner, np.logaddexp(0, z), len(docs)) + np.logaddexp(0, w[k + 1])
        # dLoss/dA: 1 for clean documents, -1 / (exp(A) - 1) for toxic ones
        slope = np.where(labels == 1, -1 / np.maximum(np.expm1(np.minimum(total, 40)), 1e-4), 1.0)
        by_sentence = slope[owner] * sigmoid(z)
        gradient = np.append(np.bincount(column, by_sentence[row], k), [by_sentence.sum(), slope.sum() * sigmoid(w[k + 1])])
        gradient /= max(1, len(docs))
        gradient[:k] += 1e-4 * w[:k]
        gradient[k] += 1e-3 * (w[k] + 4)
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient * gradient
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return dict(zip([*words, "", " "], w.tolist(), strict=True))


def _train(group: pa.Table) -> pa.Table:
    order = np.argsort(group.column("doc_id").to_numpy(), kind="stable")
    labels = group.column("label").to_numpy()[order].astype(np.int64)
    pool: dict[str, str] = {}  # one object per distinct word
    one = pool.setdefault
    docs = [[[one(w, w) for w in s] for _, _, s in sentences(group.column("text")[int(i)].as_py() or "")] for i in order]
    found = train(docs, labels)
    return pa.table({"word": pa.array(list(found), pa.string()), "weight": pa.array(list(found.values()), pa.float64())})


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict[str, float]:
    """A model of at most `SAMPLE` labelled documents of each kind, drawn by a hash of the id, and of at most `MOST_CHARS`
    characters each.

    Of several labels of one id the majority counts (ties: 1). Null labels and ids are left out.
    """
    voted = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    voted = voted.groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    limit = F.when(F.col("label") == 1, SAMPLE[1]).otherwise(SAMPLE[0])
    chosen = hash_sample(voted, "label", ["id"], limit)
    learnable = docs.select(*texts(docs)).filter(F.length("text") <= MOST_CHARS)
    rows = learnable.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))  # a bounded sample
    learned = rows.select("doc_id", "text", "label").groupBy(F.lit(0).alias("all")).applyInArrow(_train, "word string, weight double")
    return {r["word"]: r["weight"] for r in learned.collect()} or {"": -10.0, " ": -10.0}


def score(docs: DataFrame, model: dict[str, float], spans: bool = False) -> DataFrame:
    """`docs` with `score`, `predicted` and, on demand, `offending` (sentences of probability 0.5 or more)."""
    new = ["score", "predicted", *(["offending"] if spans else [])]
    keep = [c for c in docs.columns if c not in new]
    chosen = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in keep])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = dict(model)
        bias, leak = weights.pop(""), math.log1p(math.exp(weights.pop(" ")))
        known = weights.keys()
        for batch in batches:
            scores, found = [], []
            for text in batch.column("text"):
                total, places = leak, []
                for start, end, held in sentences(text.as_py() or ""):
                    if known.isdisjoint(held):
                        continue
                    z = bias + sum([weights[w] for w in held if w in weights])
                    total += math.log1p(math.exp(z)) if z < 30 else z
                    if z >= 0:
                        places.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-z))})
                scores.append(1 - math.exp(-total))
                found.append(places)
            out = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            if spans:
                out.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *out], [*keep, *new])

    more = ", offending array<struct<start: long, end: long, score: double>>" if spans else ""
    return chosen.mapInArrow(run, f"{kinds}, score double, predicted int{more}")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document by a model of labels whose fold (crc32 of the id as text, modulo 5) is not 0.

    `doc_id`, `held_out`, `score`, `predicted`, `offending`. Null and empty texts have no sentence and score as the leak. Rows with a
    null id are scored; their `held_out` is false, and texts of any length are scored whole. Without labels every text scores next to 0. Repeated rows score
    alike. An empty table gives no row; other columns are ignored.
    """
    model = fit(docs, labels.filter(part("doc_id", 5) != 0))
    held = F.coalesce(part("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return score(docs.select(*texts(docs)).select("doc_id", held, "text"), model, spans=True).drop("text")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
