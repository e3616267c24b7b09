"""Quality by the perplexity of an interpolated modified Kneser-Ney model of word trigrams.

Words and runs of signs are tokens, and all of them are counted as themselves. They go by numbers: the most frequent ones of the
trusted text by `BITS` bits, about a million more by their rank, all others by 62 bits of their hash. A trigram of the first kind of
words is one exact number, and the bigrams below it are a table of bounded size that travels to the tasks; so do the values of
the million single words. Everything else is sharded: trigrams by their first two words, which keeps a context and all that
follows it together, bigrams by their rarer word, the remaining words by themselves.

Texts never leave their task. A block of documents sends each shard the trigrams it holds there, sorted, with the
documents they stand in, as one compressed value; the shard, joined with its counts, answers with a sum per document, or hands on what
it found to the shard of the bigram, and that to those of the words. The threshold of a language is a quantile over trusted
documents that were held out of the counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import by_group, part, perhaps_in, small_batches, stored, texts
from cairngraph.llm.registry import query, table
from cairngraph.llm.text import chunks, mix, words
from cairngraph.session import cut, freed_shuffles

BITS = 12  # of a frequent word's number: 0 is any word without one, 1 the edge of a text
SIZE = 1 << BITS
RANKED = 1 << 20  # words at most whose values travel to the tasks
HASHED = 1 << 62  # words beyond those go by this and 62 bits of their hash
LEAST = 1e-4  # share of the lowest order that is spread evenly
HELD = 400_000  # distinct words, or trigrams, a task holds before it passes their counts on
BLOCK_BYTES = 1_500_000  # of text
STEP_BYTES = 200_000  # of text split into words at once: that takes forty times as much memory
LINE_BYTES = 500_000  # of encoded text counted at once
BATCH_BYTES = 8 * BLOCK_BYTES  # that go to Python at once
SHARD_BYTES = 16_000_000  # of text whose trigrams one shard gets
ROUNDS = 6  # in which documents are scored: what is shuffled for one is dropped before the next
ROUND_BYTES = 24_000_000  # of text at least, for each but the last
FOLDS = 5  # one in so many trusted documents is held out for thresholds


def packed(x: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane up to the last that any needs, compressed."""
    wide = np.ascontiguousarray(x.astype("<u8"))
    planes = max(1, -(-int(wide.max()).bit_length() // 8)) if len(wide) else 1
    wide = wide.view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + zstandard.compress(np.ascontiguousarray(wide.T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, : data[0]] = planes.T
    return wide.view("<i8").ravel()


def packed_sorted(x: np.ndarray) -> bytes:
    return packed(np.diff(x, prepend=0))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def bundled(first: np.ndarray, *more: np.ndarray) -> bytes:
    """Columns of whole numbers as one value; the first one is sorted."""
    parts = [packed_sorted(first), *map(packed, more)]
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def unbundled(data: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at : at + 8], "little")
        found.append((unpacked if found else unpacked_sorted)(data[at + 8 : end]))
        at = end
    return found


def _sent(x):
    """The value of a broadcast, or what was passed as it is."""
    return getattr(x, "value", x)


def _key(*ids: np.ndarray) -> np.ndarray:
    """One hash for each row of `ids`."""
    total = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        total = mix(total * np.uint64(0xA0761D6478BD642F) + x.astype(np.uint64) + np.uint64(1))
    return total


def _added(ids: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of `ids` that differ, with the sums of `n`."""
    if not len(n):
        return list(ids), n
    key = _key(*ids)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return [x[order[first]] for x in ids], np.add.reduceat(n[order], first)


def _sorted_bundle(*columns: np.ndarray) -> bytes:
    order = np.argsort(columns[0])
    return bundled(*(x[order] for x in columns))


class _Lookup:
    """Columns by the ids of their rows."""

    def __init__(self, ids: list[np.ndarray], *columns: np.ndarray):
        key = _key(*ids)
        order = np.argsort(key)
        self.key, self.columns = key[order], [x[order] for x in columns]

    def of(self, *ids: np.ndarray) -> list[np.ndarray]:
        """The columns at `ids`, 0 where there is no such row."""
        if not len(self.key):
            return [np.zeros(len(ids[0]), x.dtype) for x in self.columns]
        key = _key(*ids)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return [np.where(hit, x[at], 0) for x in self.columns]


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(key, return_inverse=True)
    return known, np.bincount(at, n, len(known)).astype(np.int64)


def _plus(key: np.ndarray, n: np.ndarray, keys: list[np.ndarray], ns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([key, *keys]), np.concatenate([n, *ns]))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of a task with its count; words that come again after `HELD` others come in several rows."""
    known, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for a, b in chunks(batch.column("text"), BLOCK_BYTES):
            block = batch.column("text").slice(a, b - a)
            hashes = [words(block.slice(x, y - x), True, True).hash for x, y in chunks(block, STEP_BYTES)]
            found, count = np.unique(np.concatenate(hashes), return_counts=True)
            known, n = _plus(known, n, [found], [count])
            if len(known) > HELD:
                yield pa.record_batch({"word": known.view(np.int64), "n": n})
                known, n = known[:0], n[:0]
    yield pa.record_batch({"word": known.view(np.int64), "n": n})


class Vocabulary:
    """`hashes` of the words with numbers, how many others there are, and the `ranked` ones of those, the most frequent first."""

    def __init__(self, hashes: np.ndarray, unknown: float, ranked: np.ndarray | None = None):
        self.hashes, self.unknown = np.sort(hashes.astype(np.uint64)), max(1.0, unknown)
        ranked = np.zeros(0, np.uint64) if ranked is None else ranked.astype(np.uint64)
        self.rank = np.argsort(ranked).astype(np.int32)
        self.ranked = ranked[self.rank]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 2, 0)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The number of a word that has one, `SIZE` and its rank, or `HASHED` and its hash."""
        found = self.numbers(hashes)
        rare = np.flatnonzero(found == 0)
        some = hashes[rare]
        ids = ((some >> np.uint64(2)) | np.uint64(HASHED)).astype(np.int64)
        if len(self.ranked):
            at = np.minimum(np.searchsorted(self.ranked, some), len(self.ranked) - 1)
            ids = np.where(self.ranked[at] == some, SIZE + self.rank[at].astype(np.int64), ids)
        found[rare] = ids
        return found


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The `SIZE` - 2 most frequent words, how many others there are, both from the counts of all words, and the most frequent of the others:
    as many as have one count at least, fewer than `RANKED`."""
    found = cut(docs.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    top = found.orderBy(F.desc("n"), "word").limit(SIZE - 2).toArrow().column("word").to_numpy()
    # a row for each count that a word has
    sizes = found.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toArrow()
    fits = np.flatnonzero(np.cumsum(sizes.column("words").to_numpy()) < RANKED - SIZE)
    if not len(fits):
        return Vocabulary(top.view(np.uint64), found.count() - len(top))
    often = found.filter(F.col("n") >= int(sizes.column("n")[int(fits[-1])].as_py())).toArrow()
    word, n = often.column("word").to_numpy(), often.column("n").to_numpy()
    others = np.flatnonzero(~np.isin(word, top))
    ranked = word[others[np.lexsort((word[others], -n[others]))]]
    return Vocabulary(top.view(np.uint64), found.count() - len(top), ranked.view(np.uint64))


def tokens(docs: pa.Array, number: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every token and of the end of every text that has one."""
    rows, line = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in chunks(docs, STEP_BYTES):
        w = words(docs.slice(a, b - a), True, True)
        size = np.diff(w.first)
        held = np.flatnonzero(size)
        part_ = np.ones(len(w.hash) + len(held), np.int64)
        part_[np.arange(len(w.hash)) + (np.cumsum(size > 0) - 1)[w.doc]] = number(w.hash)
        rows.append(np.repeat(held, size[held] + 1) + a)
        line.append(part_)
    return np.concatenate(rows), np.concatenate(line)


def trigrams(doc: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two words before each, the edge before the first, and the word itself."""
    first = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
    v = np.where(first, 1, np.append(1, w)[: len(w)])
    return np.where(first, 1, np.append(1, v)[: len(v)]), v, w


def _short(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Where all three words have numbers."""
    return (u < SIZE) & (v < SIZE) & (w < SIZE)


def _gram(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Three words with numbers as one."""
    gram = u << BITS
    gram |= v
    gram <<= BITS
    gram |= w
    return gram


def _context(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Two words as one number, exact where both have numbers."""
    far = ((_key(u, v) >> np.uint64(2)) | np.uint64(HASHED)).astype(np.int64)
    return np.where((u < SIZE) & (v < SIZE), (u << BITS) | v, far)


def _shard(context: np.ndarray, shards: int) -> np.ndarray:
    return (mix(context.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _split(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    # short numbers are sorted digit by digit
    order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else []
    for places in np.split(order, edges[1:]) if len(order) else []:
        yield int(shard[places[0]]), places


def _encoded(v: Vocabulary, whole: bool = False):
    """Documents as the numbers of their words, to be joined by id; `whole` with the ids of the words that have none, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column("text"), BLOCK_BYTES):
                doc, word = tokens(batch.column("text").slice(a, b - a), _sent(v).ids if whole else _sent(v).numbers)
                rare = word >= SIZE
                edge = np.searchsorted(doc, np.arange(b - a + 1))
                line = np.where(rare, 0, word).astype("<u2")  # the last words are the whole text
                out = {"doc_id": batch.column("doc_id").slice(a, b - a), "line": pa.array([line[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)], pa.binary())}
                if whole:
                    out["rare"] = pa.array([packed(word[x:y][rare[x:y]]) for x, y in zip(edge[:-1], edge[1:], strict=True)], pa.binary())
                yield pa.record_batch(out)

    return run


def _whole_line(line: bytes, rare: bytes | None) -> np.ndarray:
    x = np.frombuffer(line, "<u2").astype(np.int64)
    if rare is not None:
        x[x == 0] = unpacked(rare)
    return x


def _counted(shards: int, whole: bool = False):
    """Trigrams of encoded texts with their counts in a task, by shard; more than `HELD` come in several rows. Those with a word
    without a number come in the column `wide`."""

    def pieces(gram: np.ndarray, n: np.ndarray, wide: list[np.ndarray], more: np.ndarray) -> Iterator[pa.RecordBatch]:
        for shard, at in _split(_shard(gram >> BITS, shards)):
            yield row(shard, packed_sorted(gram[at]), packed(n[at]), None)
        for shard, at in _split(_shard(_context(wide[0], wide[1]), shards)):
            yield row(shard, packed_sorted(gram[:0]), packed(n[:0]), _sorted_bundle(*(x[at] for x in wide), more[at]))

    def row(shard: int, grams: bytes, ns: bytes, wide: bytes | None) -> pa.RecordBatch:
        out = {"shard": pa.array([shard], pa.int64()), "grams": pa.array([grams], pa.binary()), "ns": pa.array([ns], pa.binary())}
        return pa.record_batch(out | {"wide": pa.array([wide], pa.binary())} if whole else out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        known, n, wide, more = none, none, [none] * 3, none
        for batch in batches:
            for a, b in chunks(batch.column("line"), LINE_BYTES):
                some = batch.slice(a, b - a)
                rare = some.column("rare").to_pylist() if whole else [None] * (b - a)
                lines = [_whole_line(x, y) for x, y in zip(some.column("line").to_pylist(), rare, strict=True) if x]
                if not lines:
                    continue
                u, v, w = trigrams(np.repeat(np.arange(len(lines)), [len(x) for x in lines]), np.concatenate(lines))
                short = _short(u, v, w)
                found, count = np.unique(_gram(u, v, w)[short], return_counts=True)
                known, n = _plus(known, n, [found], [count])
                if not short.all():
                    far = _added([x[~short] for x in (u, v, w)], np.ones(int((~short).sum()), np.int64))
                    wide, more = _added([np.concatenate(x) for x in zip(wide, far[0], strict=True)], np.append(more, far[1]))
                if len(known) + len(more) > HELD:
                    yield from pieces(known, n, wide, more)
                    known, n, wide, more = none, none, [none] * 3, none
        yield from pieces(known, n, wide, more)

    return run


def _merged(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """The counts of one shard, how many words stand before each bigram of words with numbers in it, and the counts of counts."""
    none = np.zeros(0, np.int64)
    gram, n, wide, more = none, none, [none] * 3, none
    grams, ns, fars, held = [], [], [], 0
    whole = "wide" in group.column_names

    def gathered():
        far, m = wide, more
        if fars:
            far, m = _added([np.concatenate(x) for x in zip(wide, *(f[:3] for f in fars), strict=True)], np.concatenate([more, *(f[3] for f in fars)]))
        return *_plus(gram, n, grams, ns), far, m

    for x, y, z in zip(group.column("grams"), group.column("ns"), group.column("wide") if whole else [None] * len(group), strict=True):
        if z is not None and z.is_valid:
            fars.append(unbundled(z.as_py()))
            held += len(fars[-1][3])
        else:
            grams.append(unpacked_sorted(x.as_py()))
            ns.append(unpacked(y.as_py()))
            held += len(grams[-1])
        if held > max(HELD, len(gram) + len(more)):
            gram, n, wide, more = gathered()
            grams, ns, fars, held = [], [], [], 0
    gram, n, wide, more = gathered()
    near = (wide[1] < SIZE) & (wide[2] < SIZE)
    pair, before = np.unique(np.append(gram & (SIZE * SIZE - 1), ((wide[1] << BITS) | wide[2])[near]), return_counts=True)
    out = {
        "shard": group.column("shard")[:1].combine_chunks(),
        "grams": pa.array([packed_sorted(gram)], pa.binary()),
        "ns": pa.array([packed(n)], pa.binary()),
        "pairs": pa.array([packed_sorted(pair)], pa.binary()),
        "before": pa.array([packed(before)], pa.binary()),
        **{f"n{k}": pa.array([int((n == k).sum() + (more == k).sum())], pa.int64()) for k in range(1, 5)},
    }
    yield pa.record_batch(out | {"wide": pa.array([_sorted_bundle(*wide, more)], pa.binary())} if whole else out)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair, n in zip(batch.column("pairs").to_pylist(), batch.column("before").to_pylist(), strict=True):
            yield pa.record_batch({"pair": unpacked_sorted(pair), "n": unpacked(n)})


def _wide_pairs(shards: int):
    """Bigrams with a word without a number, and how many words stand before them in a shard, by their rarer word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wide in batch.column("wide").to_pylist():
                _, v, w, _ = unbundled(wide)
                far = (v >= SIZE) | (w >= SIZE)
                (v, w), n = _added([v[far], w[far]], np.ones(int(far.sum()), np.int64))
                for shard, at in _split(_shard(np.maximum(v, w), shards)):
                    yield pa.record_batch({"shard": pa.array([shard], pa.int64()), "pairs": pa.array([_sorted_bundle(v[at], w[at], n[at])], pa.binary())})

    return run


def _merged_pairs(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """The bigrams of one shard with their counts, and the counts of counts."""
    none = np.zeros(0, np.int64)
    ids, n = [none, none], none
    parts, held = [], 0
    for i, x in enumerate(group.column("pairs"), 1):
        parts.append(unbundled(x.as_py()))
        held += len(parts[-1][2])
        if held > max(HELD, len(n)) or i == len(group):
            ids, n = _added([np.concatenate(x) for x in zip(ids, *(p[:2] for p in parts), strict=True)], np.concatenate([n, *(p[2] for p in parts)]))
            parts, held = [], 0
    yield pa.record_batch(
        {
            "shard": group.column("shard")[:1].combine_chunks(),
            "pairs": pa.array([_sorted_bundle(*ids, n)], pa.binary()),
            **{f"n{k}": pa.array([int((n == k).sum())], pa.int64()) for k in range(1, 5)},
        }
    )


WORD_COUNTS = ("total", "once", "twice", "more", "before")


def _pair_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each word in a shard of bigrams: the sum of their counts, how many have one, two and more, and how many end with it."""
    for batch in batches:
        for pairs in batch.column("pairs").to_pylist():
            v, w, n = unbundled(pairs)
            word, at = np.unique(np.append(v, w), return_inverse=True)
            first, second = at[: len(v)], at[len(v) :]
            sums = [n, n == 1, n == 2, n >= 3]
            found = [np.bincount(first, x, len(word)) for x in sums] + [np.bincount(second, minlength=len(word))]
            yield pa.record_batch({"word": word, **{c: x.astype(np.int64) for c, x in zip(WORD_COUNTS, found, strict=True)}})


def _packed_words(shards: int):
    """Words by shard, a piece from each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("word", *WORD_COUNTS)]
            for shard, at in _split(_shard(columns[0], shards)):
                yield pa.record_batch({"shard": pa.array([shard], pa.int64()), "words": pa.array([_sorted_bundle(*(x[at] for x in columns))], pa.binary())})

    return run


def discounts(n: list[int]) -> np.ndarray:
    """0, D1, D2, D3+ from the numbers of n-grams seen once to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    found = [0.0]
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5
        found.append(min(max(d, 0.05), k - 0.05))
    return np.array(found)


LowerOrders = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Values(NamedTuple):
    """Of the words by their number or rank, how often one follows, the weight of P(next word), and P(word).

    `d` are the discounts of bigrams, `one_d` those of the numbers of words before a word, which add up to `kinds`. What
    these take goes evenly to all words, so `unseen` is P of a word that was never seen.
    """

    total: np.ndarray
    weight: np.ndarray
    one: np.ndarray
    d: np.ndarray
    one_d: np.ndarray
    kinds: int
    unseen: float


def word_values(pair: np.ndarray, n: np.ndarray, d: np.ndarray, words: pa.Table, far: list[int], v: Vocabulary) -> Values:
    """From the bigrams of words with numbers, and `words`, which has what other bigrams add. `far` is of words without number or rank: how
    many have one to four words before them, how many have three and more, and how many these are together."""
    size = SIZE + len(v.ranked)
    word = words.column("word").to_numpy()
    more = {c: words.column(c).to_numpy() for c in WORD_COUNTS}
    first = pair >> BITS
    total = np.bincount(word, more["total"], size) + np.bincount(first, n, size)
    left = np.bincount(word, _left(d, more["once"], more["twice"], more["more"]), size) + np.bincount(first, d[np.minimum(n, 3)], size)
    before = (np.bincount(word, more["before"], size) + np.bincount(pair & (SIZE - 1), minlength=size)).astype(np.int64)
    kinds = int(before.sum()) + far[5]
    one_d = discounts([int((before == k).sum()) + far[k - 1] for k in range(1, 5)])
    taken = one_d[np.minimum(before, 3)]
    # of the words that were counted and the edge; without any, all are alike
    unseen = ((taken.sum() + one_d[1:] @ [far[0], far[1], far[4]]) / kinds if kinds else 1.0) / (len(v.hashes) + 1 + v.unknown)
    one = (before - taken) / max(kinds, 1) + unseen
    weight = np.where(total > 0, left / np.maximum(total, 1), 1.0)
    return Values(*(x.astype(np.float32) for x in (total, weight, one)), d, one_d, kinds, unseen)


def _left(d: np.ndarray, once: np.ndarray, twice: np.ndarray, more: np.ndarray) -> np.ndarray:
    return d[1] * once + d[2] * twice + d[3] * more


def lower_orders(pair: np.ndarray, n: np.ndarray, values: Values | None = None) -> LowerOrders:
    """P(second word | first word) for all pairs, from the number of words seen before each pair.

    That is the first word's weight times P(second word), and the share of a pair that was seen. Shares are held for these pairs
    only, in their order: a bit for each of `SIZE` * `SIZE` pairs, and how many were seen before each 64 bits, tell the place.
    `values` are those of bigrams of all words; without, there are only words with numbers.
    """
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    first, second = pair >> BITS, pair & (SIZE - 1)
    if values is None:
        d = discounts([int((n == k).sum()) for k in range(1, 5)])[np.minimum(n, 3)]
        total = np.bincount(first, n, SIZE)
        weight = np.where(total > 0, np.bincount(first, d, SIZE) / np.maximum(total, 1), 1.0)
        one = np.bincount(second, minlength=SIZE).astype(np.float64)
        one = (1 - LEAST) * one / max(1.0, one.sum()) + LEAST / SIZE if one.sum() else np.full(SIZE, 1 / SIZE)
    else:
        d = values.d[np.minimum(n, 3)]
        total, weight, one = (x[:SIZE].astype(np.float64) for x in values[:3])
    share = ((n - d) / np.maximum(total[first], 1)).astype(np.float32)
    seen = np.zeros(SIZE * SIZE, bool)
    seen[pair] = True
    bits = np.packbits(seen, bitorder="little").view("<u8")
    count = np.bitwise_count(bits).astype(np.int32)
    return weight, one, bits, np.cumsum(count, dtype=np.int32) - count, share


def lower(orders: LowerOrders, pair: np.ndarray, unknown: float) -> np.ndarray:
    """What `lower_orders` has of pairs; the unknown word shared out."""
    weight, one, bits, before, share = orders
    second = pair & (SIZE - 1)
    p = (weight[pair >> BITS] * one[second]).astype(np.float32)
    some, bit = bits[pair >> 6], (pair & 63).astype(np.uint64)
    seen = np.flatnonzero((some >> bit) & np.uint64(1))
    below = some[seen] & ((np.uint64(1) << bit[seen]) - np.uint64(1))
    p[seen] += share[before[pair[seen] >> 6] + np.bitwise_count(below)]
    p[second == 0] /= unknown
    return p.astype(np.float64)


def trigram_counts(trusted: DataFrame, shards: int) -> tuple[DataFrame, np.ndarray, pa.Table]:
    """The sharded trigram counts of encoded documents, their discounts, and the bigrams of words with numbers."""
    whole = "rare" in trusted.columns
    more = ", wide binary" if whole else ""
    counted = trusted.select("line", *["rare"] * whole).mapInArrow(_counted(shards, whole), f"shard long, grams binary, ns binary{more}")
    counts = stored(
        counted.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            by_group(["shard"], _merged), f"shard long, grams binary, ns binary, pairs binary, before binary, n1 long, n2 long, n3 long, n4 long{more}"
        )
    )
    # at most SIZE * SIZE rows, whatever the corpus
    pairs = counts.select("pairs", "before").mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    return counts, discounts(_counts_of_counts(counts)), pairs


def _counts_of_counts(rows: DataFrame) -> list[int]:
    row = rows.agg(*[F.sum(f"n{k}") for k in range(1, 5)]).head()
    return [int(x or 0) for x in row]


def model(trusted: DataFrame, v: Vocabulary, shards: int) -> tuple[DataFrame, np.ndarray, LowerOrders]:
    """The sharded trigram counts of encoded documents, their discounts, and the lower orders; words without a number are one."""
    counts, d, pairs = trigram_counts(trusted, shards)
    return counts, d, lower_orders(pairs.column("pair").to_numpy(), pairs.column("n").to_numpy())


class Rest(NamedTuple):
    """What words without a number add to a model: bigrams and words by shard, and the values of the ranked words."""

    pairs: DataFrame
    words: DataFrame
    values: Broadcast


def whole_model(trusted: DataFrame, v: Vocabulary, shards: int) -> tuple[DataFrame, np.ndarray, LowerOrders, Rest]:
    """The same of all words, from documents encoded whole."""
    counts, d, near = trigram_counts(trusted, shards)
    pieces = counts.select("wide").mapInArrow(_wide_pairs(shards), "shard long, pairs binary")
    pairs = stored(
        pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            by_group(["shard"], _merged_pairs), "shard long, pairs binary, n1 long, n2 long, n3 long, n4 long"
        )
    )
    found = pairs.select("pairs").mapInArrow(_pair_words, ", ".join(f"{c} long" for c in ("word", *WORD_COUNTS)))
    words_ = stored(found.groupBy("word").agg(*[F.sum(c).alias(c) for c in WORD_COUNTS]))
    pair, n = near.column("pair").to_numpy(), near.column("n").to_numpy()
    seen = [x + int((n == k).sum()) for k, x in enumerate(_counts_of_counts(pairs), 1)]
    before = F.col("before")
    far = words_.filter(F.col("word") >= HASHED).agg(*[F.count_if(before == k) for k in range(1, 5)], F.count_if(before > 2), F.sum(before)).head()
    # fewer than RANKED rows
    values = word_values(pair, n, discounts(seen), words_.filter(F.col("word") < HASHED).toArrow(), [int(x or 0) for x in far], v)
    far = words_.filter(F.col("word") >= HASHED).mapInArrow(_packed_words(shards), "shard long, words binary")
    return counts, d, lower_orders(pair, n, values), Rest(pairs, stored(far), trusted.sparkSession.sparkContext.broadcast(values))


ASKED = "shard long, kind byte, block long, grams binary, ns binary"
ROWS, SUMS, OF_PAIRS, OF_FIRST, OF_SECOND = 2, 3, 12, 13, 14  # kinds of rows; 0 is a shard's counts, 1 what is asked of them


def _asked(v: Vocabulary, shards: int, whole: bool = False):
    """Of each block of documents: the rows themselves without text, and by shard the trigrams and the documents they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            if block is None and batch.num_rows:
                block = batch.column("split")[0].as_py() << 32
            for a, b in chunks(batch.column("text"), BLOCK_BYTES):
                some = batch.slice(a, b - a)
                doc, ids = tokens(some.column("text"), _sent(v).ids if whole else _sent(v).numbers)
                ids = trigrams(doc, ids)
                sink = pa.BufferOutputStream()
                rows = pa.record_batch({"doc_id": some.column("doc_id"), "lang": some.column("lang"), "n": np.bincount(doc, minlength=b - a)})
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(rows)
                found = [(block % shards, ROWS, sink.getvalue().to_pybytes(), None, None)]
                far = np.flatnonzero(~_short(*ids))
                gram, of = _gram(*ids), doc
                if len(far):
                    gram, of = np.delete(gram, far), np.delete(of, far)
                for shard, at in _split(_shard(gram >> BITS, shards)):
                    order = at[np.argsort(gram[at], kind="stable")]
                    found.append((shard, 1, packed_sorted(gram[order]), packed(of[order]), None))
                if whole:
                    far = far[np.argsort(ids[0][far])]
                    for shard, at in _split(_shard(_context(ids[0][far], ids[1][far]), shards)):
                        found.append((shard, 1, None, None, bundled(*(x[far[at]] for x in (*ids, doc)))))
                shard, kind, grams, ns, wide = zip(*found, strict=True)
                out = {
                    "shard": pa.array(shard, pa.int64()),
                    "kind": pa.array(kind, pa.int8()),
                    "block": pa.array([block] * len(shard), pa.int64()),
                    "grams": pa.array(grams, pa.binary()),
                    "ns": pa.array(ns, pa.binary()),
                }
                yield pa.record_batch(out | {"wide": pa.array(wide, pa.binary())} if whole else out)
                block += 1

    return run


ANSWERED = "shard long, kind byte, block long, docs binary, sums binary"


def _answer(shard: int, kind: int, block: int, docs: bytes | None, sums: bytes | None) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "shard": pa.array([shard], pa.int64()),
            "kind": pa.array([kind], pa.int8()),
            "block": pa.array([block], pa.int64()),
            "docs": pa.array([docs], pa.binary()),
            "sums": pa.array([sums], pa.binary()),
        }
    )


class _Outbox:
    """What leaves a task: sums of documents, and tokens for the shards that know more. It is held until there are `HELD` of them.

    A token comes as its two last words, block and document, and what is known of its probability: `has` + `share` * P(second word |
    first word). Once the bigram is known, `n` is its discounted count; once the first word is, P(second word) is left.
    """

    def __init__(self, values: Values, shards: int):
        self.values, self.shards = values, shards
        self.sums, self.asked, self.held = [], {k: [] for k in (OF_PAIRS, OF_FIRST, OF_SECOND)}, 0

    def done(self, block: np.ndarray, doc: np.ndarray, p: np.ndarray) -> None:
        self.sums.append((block, doc, np.log(p)))
        self.held += len(doc)

    def ask(self, kind: int, *token: np.ndarray) -> None:
        self.asked[kind].append(token)
        self.held += len(token[0])

    def with_pair(self, v, w, block, doc, has, share, n) -> None:
        near = v < len(self.values.total)
        at = v[near]
        total, weight = self.values.total[at], self.values.weight[at]
        self.ask(OF_FIRST, *(x[~near] for x in (v, w, block, doc, has, share, n)))
        self.with_first(*(x[near] for x in (v, w, block, doc)), *_first_known(has[near], share[near], n[near], total, weight))

    def with_first(self, v, w, block, doc, has, share) -> None:
        near = w < len(self.values.one)
        self.done(block[near], doc[near], has[near] + share[near] * self.values.one[w[near]])
        self.ask(OF_SECOND, *(x[~near] for x in (v, w, block, doc, has, share)), np.zeros(int((~near).sum()), np.float32))

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.sums:
            block, doc, value = (np.concatenate(x) for x in zip(*self.sums, strict=True))
            (block, doc), value = _added([block, doc], value)
            order = np.lexsort((doc, block))
            for _, at in _split(block[order]):
                at = order[at]
                number = int(block[at[0]])
                yield _answer(number % self.shards, SUMS, number, packed(doc[at]), value[at].astype("<f4").tobytes())
        for kind, tokens in self.asked.items():
            if not tokens:
                continue
            v, w, block, doc, *known = (np.concatenate(x) for x in zip(*tokens, strict=True))
            by = {OF_PAIRS: np.maximum(v, w), OF_FIRST: v, OF_SECOND: w}[kind]
            for shard, at in _split(_shard(by, self.shards)):
                at = at[np.argsort(v[at])]
                blocks, place = np.unique(block[at], return_inverse=True)
                bits = [x[at].astype(np.float32).view(np.uint32) for x in known]
                yield _answer(shard, kind, -1, bundled(v[at], w[at], place, doc[at], *bits), packed_sorted(blocks))
        self.__init__(self.values, self.shards)


def _first_known(has, share, n, total, weight):
    """With the first word's values: what a token has, and the share of P(second word)."""
    return has + share * n / np.maximum(total, 1), share * weight


def _answered(d: np.ndarray, orders, unknown: float, values=None, shards: int = 1):
    """Of a partition sorted by shard, each with its counts before the trigrams asked for: sums of log probabilities by document, and
    the blocks' rows as they are. The counts of one shard and a batch are held, however much is asked of it. With `values`, tokens
    whose bigram is not among `orders` go on to its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, last = np.zeros(0, np.int64), None
        out = _Outbox(values.value, shards) if values is not None else None
        for batch in batches:
            wides = batch.column("wide") if out is not None else [None] * batch.num_rows
            for row in range(batch.num_rows):
                shard, kind, block, grams, ns = (batch.column(c)[row].as_py() for c in ("shard", "kind", "block", "grams", "ns"))
                wide = unbundled(wides[row].as_py()) if out is not None and wides[row].is_valid else None
                if shard != last:
                    last, known, n, context, total, weight = shard, none, none, none, np.zeros(0), np.zeros(0)
                    far = _Lookup([none, none, none], none)
                if kind == 0:
                    known, n = unpacked_sorted(grams), unpacked(ns)
                    of, every = known >> BITS, n
                    if wide is not None:
                        far = _Lookup(wide[:3], wide[3])
                        of, every = np.append(of, _context(*wide[:2])), np.append(n, wide[3])
                    order = np.argsort(of)
                    of, every = of[order], every[order]
                    first = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
                    context = of[first]
                    if len(of):
                        total = np.add.reduceat(every, first)
                        weight = np.add.reduceat(d[np.minimum(every, 3)], first) / total
                    continue
                if kind == 1 and wide is not None:
                    u, v, w, doc = wide
                    has, share = np.zeros(len(u)), np.ones(len(u))
                    if len(context):
                        asked = _context(u, v)
                        c = np.minimum(np.searchsorted(context, asked), len(context) - 1)
                        seen = np.flatnonzero(context[c] == asked)
                        c = c[seen]
                        (count,) = far.of(u[seen], v[seen], w[seen])
                        share[seen], has[seen] = weight[c], (count - d[np.minimum(count, 3)]) / total[c]
                    near, at = (v < SIZE) & (w < SIZE), np.full(len(u), block)
                    p = has[near] + share[near] * lower(orders.value, ((v << BITS) | w)[near], unknown)
                    out.done(at[near], doc[near], p)
                    out.ask(OF_PAIRS, *(x[~near] for x in (v, w, at, doc, has, share)), np.zeros(int((~near).sum())))
                    if out.held > HELD:
                        yield from out.flush()
                    continue
                if kind == 1:
                    gram, doc = unpacked_sorted(grams), unpacked(ns)
                    some, at = np.unique(gram, return_inverse=True)
                    p = lower(orders.value, some & (SIZE * SIZE - 1), unknown)
                    if len(context):
                        c = np.minimum(np.searchsorted(context, some >> BITS), len(context) - 1)
                        seen = context[c] == some >> BITS
                        p = np.where(seen, weight[c] * p, p)
                    if len(known):
                        k = np.minimum(np.searchsorted(known, some), len(known) - 1)
                        hit = known[k] == some
                        share = (n[k] - d[np.minimum(n[k], 3)]) / total[c]
                        # the unknown word is shared out at every order
                        p = np.where(hit, p + np.where(some & (SIZE - 1) == 0, share / unknown, share), p)
                    value = np.bincount(doc, np.log(p)[at])
                    kind, grams, ns = SUMS, packed(np.unique(doc)), value[np.unique(doc)].astype("<f4").tobytes()
                yield _answer(block % shards, kind, block, grams, ns)
        if out is not None:
            yield from out.flush()

    return run


def _looked_up(kind: int, values, shards: int):
    """Of a partition sorted by shard, each with its bigrams or words before the tokens that ask for them: sums, tokens that go on, and
    all other rows as they are."""

    def columns(parts: list[list[np.ndarray]]) -> _Lookup:
        keys = 2 if kind == OF_PAIRS else 1
        held = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * (3 if keys == 2 else 6)
        return _Lookup(held[:keys], *held[keys:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = values.value
        out, last, parts, table_ = _Outbox(known, shards), None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                shard, its, block, docs, sums = (batch.column(c)[row].as_py() for c in ("shard", "kind", "block", "docs", "sums"))
                if shard != last:
                    last, parts, table_ = shard, [], None
                if its == 0:
                    parts.append(unbundled(docs))
                    continue
                if its != kind:
                    yield _answer(shard, its, block, docs, sums)
                    continue
                if table_ is None:
                    table_, parts = columns(parts), []
                v, w, place, doc, *bits = unbundled(docs)
                blocks = unpacked_sorted(sums)[place]
                has, share, n = (x.astype(np.uint32).view(np.float32).astype(np.float64) for x in bits)
                if kind == OF_PAIRS:
                    (count,) = table_.of(v, w)
                    out.with_pair(v, w, blocks, doc, has, share, np.where(count > 0, count - known.d[np.minimum(count, 3)], 0.0))
                elif kind == OF_FIRST:
                    total, *some, _ = table_.of(v)
                    weight = np.where(total > 0, _left(known.d, *some) / np.maximum(total, 1), 1.0)
                    out.with_first(v, w, blocks, doc, *_first_known(has, share, n, total, weight))
                else:
                    before = table_.of(w)[-1]
                    one = (before - known.one_d[np.minimum(before, 3)]) / max(known.kinds, 1) + known.unseen
                    out.done(blocks, doc, has + share * one)
                if out.held > HELD:
                    yield from out.flush()
        yield from out.flush()

    return run


def _joined(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """One block: its rows, with the sums of all shards."""
    rows, parts = None, []
    for kind, docs, sums in zip(*(group.column(c).to_pylist() for c in ("kind", "docs", "sums")), strict=True):
        if kind == ROWS:
            rows = pa.ipc.open_stream(docs).read_all()
        else:
            parts.append((unpacked(docs), np.frombuffer(sums, "<f4")))
    total = np.zeros(rows.num_rows)
    for at, value in parts:
        total[at] += value
    for batch in rows.to_batches():
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "n": batch.column("n"), "logp": total[: batch.num_rows]})


def by_shard(rows: DataFrame, step: Callable) -> DataFrame:
    return rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(step, ANSWERED)


def perplexities(docs: DataFrame, counts: DataFrame, d: np.ndarray, orders: LowerOrders, v: Vocabulary, shards: int, rest: Rest | None = None) -> DataFrame:
    """`doc_id`, `lang`, `n_tokens`, `perplexity` of every row; null where there is nothing to score.

    Without the `rest` of the model, words without a number are one unknown word that shares its probability among as many words as there are.
    """
    plain = docs.select(*texts(docs), F.col("lang").cast("string").alias("lang"), F.spark_partition_id().cast("long").alias("split"))
    more = ["wide"] if rest else []
    asked = plain.mapInArrow(_asked(v, shards, rest is not None), ASKED + "".join(f", {c} binary" for c in more))
    counted, zero = F.lit(0).cast("byte").alias("kind"), F.lit(0).cast("long").alias("block")
    held = counts.select("shard", counted, zero, "grams", "ns", *more)
    values = rest.values if rest else None
    sent = orders if hasattr(orders, "value") else docs.sparkSession.sparkContext.broadcast(orders)
    step = _answered(d, sent, _sent(v).unknown, values, shards)
    answered = by_shard(asked.unionByName(held), step)
    if rest:
        none = F.lit(None).cast("binary").alias("sums")
        for kind, table_, column in ((OF_PAIRS, rest.pairs, "pairs"), (OF_FIRST, rest.words, "words"), (OF_SECOND, rest.words, "words")):
            known = table_.select("shard", counted, zero, F.col(column).alias("docs"), none)
            answered = by_shard(answered.unionByName(known), _looked_up(kind, values, shards))
    summed = answered.repartition("block").sortWithinPartitions("block").mapInArrow(by_group(["block"], _joined), "doc_id long, lang string, n long, logp double")
    value = F.when(F.col("n") > 0, F.exp(-F.col("logp") / F.col("n")))
    return summed.select("doc_id", "lang", F.col("n").alias("n_tokens"), value.alias("perplexity"))


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.99) -> DataFrame:
    """`doc_id`, `lang`, `n_tokens`, `perplexity`, `threshold`, `kept` for every row of `docs`.

    `trusted_ids` (`doc_id`) names the trusted documents. Those whose crc32 of the id as text `FOLDS` does not divide are
    counted; the threshold of a language is the `quantile` of the others' perplexities, for languages without any (and null)
    that of all of them. Null and blank texts have no perplexity and are not kept. Texts of any length are scored
    whole; repeated rows are scored alike, rows with a null id are scored. Without held-out text nothing has a threshold and
    every text that has a perplexity is kept. An empty table gives no row; other columns are ignored. Rows of a split
    have to come in the same order when a task runs again, as they do from files.
    """
    ids = trusted_ids.select(F.col("doc_id").cast("long").alias("t")).filter("t is not null").distinct()
    bytes_ = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).head()[0] or 0
    shards = max(4, -(-bytes_ // SHARD_BYTES))
    perhaps = perhaps_in(docs.select(*texts(docs)), "doc_id", ids).filter("perhaps").select("doc_id", "text")
    with small_batches(docs.sparkSession, BATCH_BYTES), freed_shuffles(docs.sparkSession):
        send = docs.sparkSession.sparkContext.broadcast
        v = vocabulary(perhaps)
        sent = send(v)
        encoded = perhaps.mapInArrow(_encoded(sent, True), "doc_id long, line binary, rare binary").filter(part("doc_id", FOLDS) != 0)
        counts, d, orders, rest = whole_model(encoded.join(ids, encoded["doc_id"] == ids["t"], "left_semi"), v, shards)
        orders = send(orders)
        rounds = min(ROUNDS, 1 + bytes_ // ROUND_BYTES)
        turn = F.pmod(F.xxhash64("doc_id", F.octet_length(F.col("text").cast("string"))), F.lit(rounds))
        found = reduce(DataFrame.unionByName, [stored(perplexities(docs.filter(turn == i), counts, d, orders, sent, shards, rest)) for i in range(rounds)])
    own = found.filter(part("doc_id", FOLDS) == 0).join(ids, F.col("doc_id") == F.col("t"), "left_semi")
    bound = F.percentile_approx("perplexity", quantile, 10_000).alias("bound")
    langs = cut(own.groupBy("lang").agg(bound)).withColumnsRenamed({"lang": "l", "bound": "own"})
    every = own.agg(bound)  # one row
    joined = found.join(langs.filter("l is not null"), F.col("lang") == F.col("l"), "left").join(F.broadcast(every))
    threshold = F.coalesce("own", "bound")
    return joined.select(
        "doc_id",
        "lang",
        "n_tokens",
        "perplexity",
        threshold.alias("threshold"),
        (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"),
    )


@query("op5_perplexity")
def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return classify(table(spark, sf_dir, "documents"), trusted)
