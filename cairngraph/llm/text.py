"""Words, shingles and their hashes over Arrow string columns, whole batches at a time.

A word is a run of bytes other than ASCII white space (`[^\\x20\\x09-\\x0D]+`). Hashes are 64-bit, the same
on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000  # of text per vectorised step; a longer document is a step of its own
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = 64
_STEP = np.uint64(0xA0761D6478BD642F)


class Words(NamedTuple):
    """Words of `n_docs` documents: `doc` is the row within the chunk, `first` the first word of each document."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    n_docs: int


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# a random number for each place of a word and byte there; a word's hash has no structure that words could be built to meet
_LETTERS = mix(mix(np.arange(_PLACES * 256, dtype=np.uint64) + _ODD) ^ _STEP)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose text stays below `limit` bytes (or one longer row)."""
    lengths = np.asarray(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    start, held = 0, 0
    for row, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield start, row
            start, held = row, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the offsets of each; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, fold: bool = False, signs: bool = False) -> Words:
    """Split and hash all words of a chunk. `fold` lower-cases A-Z. With `signs`, runs of ASCII signs are words of their own and
    all digits are alike."""
    data, offsets = raw(texts)
    n_docs = len(offsets) - 1
    if fold:
        data = np.where((data >= 65) & (data <= 90), data | 32, data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    solid = ~space
    before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    before[1:], after[:-1] = np.append(space, True)[: len(data)], np.append(space, True)[1:]
    if signs:
        digit = (data >= 48) & (data <= 57)
        data = np.where(digit, 48, data)
        lower = data | 32
        sign = (data < 128) & ~digit & ~((lower >= 97) & (lower <= 122))
        change = np.flatnonzero(sign[1:] != sign[:-1])
        before[change + 1] = after[change] = True
    before[offsets[:-1]] = True
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    after[ends_at] = True
    start = np.flatnonzero(solid & before[: len(data)])
    end = np.flatnonzero(solid & after[: len(data)]) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    length = end - start
    if len(start):
        at = np.cumsum(length) - length
        place = np.arange(length.sum(), dtype=np.int64) - np.repeat(at, length)
        value = data[solid]
        far = np.flatnonzero(place >= _PLACES)
        each = _LETTERS[np.minimum(place, _PLACES - 1) * 256 + value]
        each[far] = mix(each[far] + place[far].astype(np.uint64) * _ODD)
        hashed = np.add.reduceat(each, at)
        hashed = mix(hashed + length.astype(np.uint64) * _ODD)
    else:
        hashed = np.zeros(0, np.uint64)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    return Words(data, doc, start, end, hashed, first, n_docs)


def runs(w: Words, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `n` consecutive words, and whether each stays in one document (n - 1 shorter than the words)."""
    m = len(w.hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = np.full(m, np.uint64(salt))
    for j in range(n):
        total = total * _STEP + w.hash[j : j + m]
    return mix(total), w.doc[:m] == w.doc[n - 1 :]


def winnow(w: Words, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of `size` words inside a document: its position, and position and hash of its anchor.

    The anchor is the leftmost least hash among the runs of `anchor` words in the window; it depends on the window's
    words alone, so equal windows have equal anchors wherever they stand.
    """
    grams, _ = runs(w, anchor, salt=1)
    m = len(w.hash) - size + 1
    if m <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    least, place = grams[:m].copy(), np.arange(m)
    for j in range(1, size - anchor + 1):
        other = grams[j : j + m]
        less = other < least
        least[less] = other[less]
        place[less] = np.flatnonzero(less) + j
    inside = w.doc[:m] == w.doc[size - 1 :]
    return np.flatnonzero(inside), place[inside], least[inside]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
