"""Packing of tokenised documents into fixed windows by order-preserving dynamic programming.

The documents of a scan partition form one stream of tokens in table order. `cuts` chooses where the stream is cut so
that padding plus cut penalties is least: a cut at a document's end costs nothing, one after a sentence little, one inside
a sentence more. With g(i) = cost up to cut i + i, the best predecessor of a cut j is the least g over the cuts of the
last `size` tokens: a monotone queue keeps that minimum in constant amortised time. A window whose length is a power of
two needs no padding and is tried besides.

Nothing is shuffled and no stream is held: after `segment` tokens the program is closed at a document's end and its
pieces leave. Memory is one Arrow batch of token ids and one segment's candidate cuts. Lost tasks are recomputed from the
scan alone.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import texts
from cairngraph.llm.registry import query, table

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " sequence_length long"
)

PLACES = 200_000  # of filled windows that are tried along one run without a sentence end


def byte_tokens(tokenizer) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer as bytes -> id, without special tokens.

    Byte-level files write each byte as a printable character: printable Latin-1 as itself, the others from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    return {bytes(of[x] for x in token): i for token, i in vocab.items() if token not in special}


class Encoder:
    """Token ids of texts exactly as the `tokenizers` library gives them for a byte-level file.

    `tiktoken` does the work with the file's vocabulary as ranks. White space needs the pattern's look-ahead only where
    two blanks meet; all other texts use the pattern without it, which is faster. Texts that hold a special token's
    text go through `tokenizers` itself.
    """

    _pair = re.compile(r"\s\s")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.path, self.tokenizer = path, None  # the library's own object is large and seldom needed
        ranks = byte_tokens(tokenizer)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.ends, self.opens = sentence_ends(tokenizer)
        self.any = tiktoken.Encoding("any", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        single = PATTERN.replace(r"|\s+(?!\S)", "")
        self.single = tiktoken.Encoding("one", pat_str=single, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if any(s in text for s in self.special):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.path)
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif self._pair.search(text):
            ids = self.any(text)
        else:
            ids = self.single(text)
        return array("I", ids).tobytes()


def sentence_ends(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """By token id: whether its text ends a sentence, and whether it begins with white space."""
    n = max(tokenizer.get_vocab().values()) + 1
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in range(n)]
    ends = np.array([t.rstrip()[-1:] in (".", "!", "?") or t.endswith("\n") for t in texts])
    return ends, np.array([t[:1].isspace() for t in texts])


def cuts(at: np.ndarray, penalty: np.ndarray, size: int = 2048, inside: float = 24.0) -> list[int]:
    """Cut positions of a stream, ascending, the last one its end.

    `at` are candidate positions, ascending, the last one the stream's end, with a `penalty` each; a cut elsewhere costs
    `inside` and is tried where it fills a window begun at a candidate. Windows of a power of two cost no padding.
    """
    powers = [1 << k for k in range(size.bit_length() - 1) if (1 << k) >= min(32, size)]
    end = int(at[-1])
    gaps = np.diff(at, prepend=0)
    hard = at[:-1] + size
    # a filled window is worth a cut inside a sentence only if the last candidate before it leaves more padding
    last = np.searchsorted(at, hard, "right") - 1
    more = [hard[(hard < end) & (hard - at[last] > inside)]]
    for g in np.flatnonzero(gaps > size).tolist():  # sentences longer than a window
        begin = at[g] - gaps[g]
        # filled windows may go on from any candidate shortly before
        before = at[slice(*np.searchsorted(at, [begin - size, begin], "right"))]
        before = before if begin >= size else np.append(before, 0)
        # in a run of very many windows the nearest of them do, so that places stay bounded
        before = before[-max(16, PLACES * size // int(gaps[g])) :]
        more.append((before[:, None] + np.arange(size, gaps[g] + size, size)).ravel())
    more.append(np.array([end - p for p in powers if end > p] + [size] * (end > size), dtype=np.int64))
    places = np.unique(np.concatenate([[0], at, *more]))
    places = places[places <= end]
    cost = np.full(len(places), inside)
    cost[np.searchsorted(places, at)] = penalty
    exact: dict[int, list[int]] = {}  # windows of a power of two between candidates
    for p in powers[-3:]:
        origin = np.minimum(np.searchsorted(places, places - p), len(places) - 1)
        hit = np.flatnonzero((places[origin] == places - p) & (places >= p))
        for j, i in zip(hit.tolist(), origin[hit].tolist(), strict=True):
            exact.setdefault(j, []).append(i)
    where, fixed = places.tolist(), cost.tolist()
    best = [0.0] * len(where)
    back = [0] * len(where)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])
    for j in range(1, len(where)):
        place = where[j]
        low = place - size
        while queue[0][1] < low:
            queue.popleft()
        least, _, i = queue[0]
        least += size - place
        for other in exact.get(j, ()):
            if best[other] < least:
                least, i = best[other], other
        least += fixed[j]
        best[j], back[j] = least, i
        g = least + place
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, place, j))
    found = []
    j = len(where) - 1
    while j > 0:
        found.append(where[j])
        j = back[j]
    return found[::-1]


def _packed(path: str, id_end: int, size: int, sentence: float, inside: float, segment: int):
    """The `mapInArrow` function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        ends, opens = encoder.ends, encoder.opens
        table_size = max(len(ends), id_end + 1)
        ends = np.append(ends, np.zeros(table_size - len(ends), bool))
        opens = np.append(opens, np.ones(table_size - len(opens), bool))
        base = TaskContext.get().partitionId() << 33
        done = 0
        docs: list[tuple[int | None, bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal done, docs, held
            lengths = np.array([len(b) // 4 for _, b in docs])
            stop = np.cumsum(lengths)
            ids = np.frombuffer(b"".join(b for _, b in docs), "<u4")
            after = np.append(ids[1:], id_end)
            soft = ends[ids] & opens[after]
            soft[stop - 1] = True
            at = np.flatnonzero(soft) + 1
            cost = np.full(len(at), sentence)
            cost[np.searchsorted(at, stop)] = 0.0
            chosen = np.array(cuts(at, cost, size, inside), dtype=np.int64)
            begins = np.concatenate([[0], chosen[:-1]])
            # pieces: the stream cut at window and document ends
            edges = np.unique(np.concatenate([chosen, stop]))
            starts = np.concatenate([[0], edges[:-1]])
            doc = np.searchsorted(stop, starts, "right")
            window = np.searchsorted(begins, starts, "right") - 1
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), edges.tolist(), strict=True)]
            names = [i for i, _ in docs]
            out = pa.record_batch(
                {
                    "doc_id": pa.array([names[d] for d in doc.tolist()], pa.int64()),
                    "start": starts - (stop - lengths)[doc],
                    "length": edges - starts,
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": lengths[doc],
                    "sequence_id": base + done + window,
                    "offset": starts - begins[window],
                    "sequence_length": (chosen - begins)[window],
                }
            )
            done += len(chosen)
            docs, held = [], 0
            return out

        end = np.array([id_end], "<u4").tobytes()
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for key, text in zip(keys, batch.column("text"), strict=True):
                docs.append((key, encoder.encode(text.as_py() or "") + end))
                held += len(docs[-1][1]) // 4
                if held >= segment:
                    yield flush()
        if docs:
            yield flush()

    return run


def pack(
    docs: DataFrame,
    path: str,
    size: int = 2048,
    id_end: int = 1,
    sentence: float = 4.0,
    inside: float = 24.0,
    segment: int = 1_000_000,
) -> DataFrame:
    """Pieces of all documents in windows of at most `size` tokens; every token is in exactly one piece.

    A document is its ids by the tokenizer file `path` and `id_end`. Null and empty texts are that one id. Repeated rows
    and repeated or null ids are documents of their own, told apart by their pieces; an empty table gives no piece.
    Columns other than `doc_id` and `text` are ignored. `sentence` and `inside` are the penalties, in tokens of padding.
    """
    plain = docs.select(*texts(docs))
    return plain.mapInArrow(_packed(path, id_end, size, sentence, inside, segment), PIECES)


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
