"""Removal of repeated passages by seed and extend.

Seeds: every window of `size` words has one winnowed anchor (a short run of words chosen by the window's words alone), so
two documents that share a window share its anchor. Documents are joined on anchors, and only anchors of two documents or
more go on. Extension: each seed is extended to the left and to the right, word by word, to all the windows it anchors,
and these are matched over the documents. Overlapping and touching matches merge into maximal repeats of at least `size`
words; what a document with a smaller id also has is cut.

Shuffled are anchors (a fifth of the words) and the texts by id once, and the windows of seeds only. Hot passages: of an
anchor or a window that a batch meets in several documents only the first leaves the task, the others are settled there
and travel as short lists of their document. So no key has more rows than there are batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairngraph.llm.common import over_batches, texts
from cairngraph.llm.registry import query, table
from cairngraph.llm.text import Words, chunks, mix, runs, signed, winnow, words

MARK = "__row"


ROWS = "kind byte, key long, doc long, shared boolean, more binary"


def _text_keys(w: Words) -> np.ndarray:
    """A hash of each row's sequence of words, the same in every chunk: places hold for rows of equal words only."""
    found = np.zeros(w.n_docs, np.uint64)
    held = np.flatnonzero(np.diff(w.first))
    if len(held):
        place = (np.arange(len(w.hash)) - w.first[w.doc]).astype(np.uint64)
        found[held] = np.add.reduceat(mix(w.hash ^ mix(place + np.uint64(1))), w.first[held])
    return signed(found)


def _firsts(key: np.ndarray, doc: np.ndarray, value: np.ndarray, kind: str, text: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Kind 0: each key with the least document of this batch that has it, and whether others have it too. Kind 1: the
    other documents that have it, each with the `value`s of all such keys as one binary. Values that hold for one text
    only come with its key `text`: each text of a document has a binary of its own then, and the key leads it.
    """
    one = text is None
    text = np.zeros(len(key), np.int64) if one else text
    order = np.lexsort((value, doc, key))
    key, doc, value, text = key[order], doc[order], value[order], text[order]
    if not len(key):
        return
    new = np.append(True, key[1:] != key[:-1])
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    last = np.append(lead[1:], len(key)) - 1
    yield pa.record_batch(
        {
            "kind": np.zeros(len(lead), np.int8),
            "key": key[lead],
            "doc": doc[lead],
            "shared": pa.array(doc[last] > doc[lead]),
            "more": pa.nulls(len(lead), pa.binary()),
        }
    )
    late = np.flatnonzero(doc > doc[lead][group])
    if not len(late):
        return
    late = late[np.lexsort((value[late], text[late], doc[late]))]
    edges = np.flatnonzero(np.append(True, (doc[late][1:] != doc[late][:-1]) | (text[late][1:] != text[late][:-1])))
    heads = [b"" if one else x.tobytes() for x in text[late][edges].astype("<i8")]
    lists = np.split(value[late], edges[1:])
    yield pa.record_batch(
        {
            "kind": np.ones(len(edges), np.int8),
            "key": doc[late][edges],
            "doc": doc[late][edges],
            "shared": pa.array(np.ones(len(edges), bool)),
            "more": pa.array([h + x.astype(kind).tobytes() for h, x in zip(heads, lists, strict=True)], pa.binary()),
        }
    )


def _anchors(size: int, anchor: int):
    """Anchors of documents."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, ids = batch.column("text"), batch.column("doc_id").to_numpy()
        keys, docs = [], []
        for a, b in chunks(texts):
            w = words(texts.slice(a, b - a))
            _, place, least = winnow(w, size, anchor)
            place, first = np.unique(place, return_index=True)
            keys.append(signed(least[first]))
            docs.append(ids[a:b][w.doc[place]])
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)]
        yield from _firsts(key[new], doc[new], key[new], "<i8")

    return over_batches(step)


def _lists(
    batch: pa.RecordBatch, keys: str, more: str, kind: str, text: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and value of the list column `keys`, and of the binaries in `more`; with `text`, of those led by the row's key."""
    found = batch.column(keys)
    rows = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(found).fill_null(0).to_numpy())
    blobs = [(r, x) for r, held in enumerate(batch.column(more).to_pylist()) for x in held or ()]
    if text is not None:
        own = [x.tobytes() for x in text.astype("<i8")]
        blobs = [(r, x[8:]) for r, x in blobs if x[:8] == own[r]]
    blobs = [(r, np.frombuffer(x, kind)) for r, x in blobs]
    other_rows = np.repeat([r for r, _ in blobs], [len(x) for _, x in blobs]).astype(np.int64)
    return rows, np.asarray(found.flatten()), other_rows, np.concatenate([np.zeros(0, kind), *(x for _, x in blobs)])


def _windows(size: int, anchor: int):
    """Windows around seeds, with their places in the document as values."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, ids = batch.column("text"), batch.column("doc_id").to_numpy()
        keys, docs, places, rows_text = [], [], [], []
        for a, b in chunks(texts):
            w = words(texts.slice(a, b - a))
            start, _, least = winnow(w, size, anchor)
            rows, hits, more_rows, more = _lists(batch.slice(a, b - a), "keys", "more", "<i8")
            grams, _ = runs(w, size, salt=2)
            doc = w.doc[start]
            # a seed is a pair of document and anchor
            has = _member(doc, signed(least), np.concatenate([rows, more_rows]), np.concatenate([hits, more]).astype(np.int64))
            keys.append(signed(grams[start[has]]))
            docs.append(ids[a:b][doc[has]])
            places.append(start[has] - w.first[doc[has]])
            rows_text.append(_text_keys(w)[doc[has]])
        yield from _firsts(np.concatenate(keys), np.concatenate(docs), np.concatenate(places), "<i4", np.concatenate(rows_text))

    return over_batches(step)


def _gathered(rows: DataFrame) -> DataFrame:
    """`keys` and `more` of each document."""
    return rows.groupBy("doc").agg(
        F.collect_list(F.when(F.col("kind") == 0, F.col("key"))).alias("keys"), F.collect_list("more").alias("more")
    )


def _member(row: np.ndarray, value: np.ndarray, other_row: np.ndarray, other_value: np.ndarray) -> np.ndarray:
    """Which pairs (row, value) occur among the other pairs."""
    known, code = np.unique(np.concatenate([value, other_value]), return_inverse=True)
    n = len(known) + 1
    mine = row.astype(np.int64) * n + code[: len(value)]
    theirs = other_row.astype(np.int64) * n + code[len(value) :]
    return np.isin(mine, theirs)


def _cut(size: int, untouched: bool):
    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column("text")
        for a, b in chunks(texts):
            some = batch.slice(a, b - a)
            w = words(some.column("text"))
            grams, inside = runs(w, size, salt=2)
            n = len(w.hash)
            change = np.zeros(n + 1, np.int64)
            rows, keys, more_rows, places = _lists(some, "keys", "more", "<i4", _text_keys(w))
            if len(rows):
                touched = np.isin(w.doc[: len(grams)], rows) & inside
                at = np.flatnonzero(touched)
                at = at[_member(w.doc[at], signed(grams[at]), rows, keys.astype(np.int64))]
                np.add.at(change, at, 1)
                np.add.at(change, at + size, -1)
            at = places + w.first[more_rows]
            np.add.at(change, at, 1)
            np.add.at(change, at + size, -1)
            gone = np.cumsum(change[:-1]) > 0
            n_words = np.diff(w.first)
            n_removed = np.bincount(w.doc[gone], minlength=b - a)
            kept, spans = [], []
            for row, text in enumerate(some.column("text").to_pylist()):
                if untouched and not n_removed[row]:
                    spans.append([])
                    kept.append(text)
                    continue
                pieces = (text or "").encode().split()
                flags = gone[w.first[row] : w.first[row + 1]]
                if n_removed[row]:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]]).astype(np.int8)))
                    spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                    pieces = [p for p, g in zip(pieces, flags.tolist(), strict=True) if not g]
                else:
                    spans.append([])
                kept.append(b" ".join(pieces).decode())
            yield pa.record_batch(
                {
                    MARK: some.column(MARK),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.string()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                }
            )

    return over_batches(step)


def remove_repeats(docs: DataFrame, size: int = 13, anchor: int = 6, untouched: bool = False) -> DataFrame:
    """The `docs` without words covered by a window of `size` words that also starts in a document of smaller id.

    Returns the columns of `docs` but `text`, with `n_words`, `n_removed`, `kept_text` (kept words joined by one blank) and
    `spans` (cut maximal repeats as word ranges, end exclusive); columns of these names are replaced. With `untouched`, the
    `kept_text` of documents without a cut is their text as it is. Null and empty texts have no words. A
    passage repeated inside one document only stays. Rows that share an id are one document to this rule: they never cut
    each other, and a window of one is a window of both. Rows with a null id are neither cut nor a source of cuts. An empty
    table gives an empty table.
    """
    if not 0 < anchor <= size:
        raise ValueError("anchor must lie between 1 and size")
    new = ("n_words", "n_removed", "kept_text", "spans")
    rest = [c for c in docs.columns if c not in (*new, "doc_id", "text")]
    plain = docs.select(
        *texts(docs),
        F.struct(*[F.col(f"`{c}`") for c in ("doc_id", "text", *rest) if c != "text"]).alias(MARK),
    )
    # both joins read the same exchange of the texts, so they ask for the same columns and rows
    named = plain.filter("doc_id is not null")
    key = Window.partitionBy("kind", "key").orderBy("doc")
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    anchors = named.select("doc_id", "text").mapInArrow(_anchors(size, anchor), ROWS)
    several = F.max("shared").over(whole) | (F.first("doc").over(whole) < F.last("doc").over(whole))
    seeds = _gathered(anchors.withColumn("several", several).filter("several"))
    seeded = named.join(seeds, named["doc_id"] == seeds["doc"]).select("doc_id", "text", MARK, "keys", "more")
    windows = seeded.mapInArrow(_windows(size, anchor), ROWS)
    found = _gathered(windows.withColumn("least", F.first("doc").over(key)).filter("kind = 1 or least < doc"))
    joined = named.join(found, named["doc_id"] == found["doc"], "left").select(MARK, "text", "keys", "more")
    nothing = plain.filter("doc_id is null").select(
        MARK, "text", F.lit(None).cast("array<bigint>").alias("keys"), F.lit(None).cast("array<binary>").alias("more")
    )
    mark = joined.schema[MARK].dataType.simpleString()
    cut = joined.unionByName(nothing).mapInArrow(
        _cut(size, untouched),
        f"{MARK} {mark}, n_words long, n_removed long, kept_text string, spans array<struct<start: long, end: long>>",
    )
    return cut.select(f"{MARK}.*", *new)


ORACLE = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), p as (
  select doc_id, words, unnest(range(1, len(words) - 11)) as i from w where len(words) >= 13
), g as (
  select doc_id, i, list_slice(words, i, i + 12) as gram from p
), r as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by gram) as least from g) where least < doc_id
), c as (
  select distinct doc_id, unnest(range(i, i + 13)) as i from r
), k as (
  select w.doc_id, n.i, words[n.i] as word from w, unnest(range(1, len(words) + 1)) as n(i)
), t as (
  select k.doc_id, string_agg(k.word, ' ' order by k.i) as kept
  from k anti join c on k.doc_id = c.doc_id and k.i = c.i group by k.doc_id
), m as (select doc_id, count(*) as n from c group by doc_id)
select w.doc_id, cast(len(w.words) as bigint) as n_words, cast(coalesce(m.n, 0) as bigint) as n_removed,
  sha256(coalesce(t.kept, '')) as kept_sha256
from w left join t on w.doc_id = t.doc_id left join m on w.doc_id = m.doc_id
"""


@query("op4_substring_dedup", ORACLE)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), size=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
