"""Exact byte-pair encoding in linear time by backtracking, and decoding by an offset table.

An Aho-Corasick pass over a word finds the longest token at every place. The encoder takes them from left to right; a
token may follow another only if the pair is compatible, that is if merging both together gives just these two. Where no
token fits, the last one is taken back for its next shorter prefix and the place is marked as a dead end, so every place
fails once at most. The result equals applying the merges by rank.

Scans are mapped batch by batch: no shuffle, no state beyond the tables and a bounded cache of words per task.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import texts
from cairngraph.llm.registry import query, table

CACHE_WORDS = 300_000
CACHE_LETTERS = 64  # longer words and pieces are encoded each time, so the caches are bounded in bytes
BASE = -1


class WordTokenizer:
    """A byte-level BPE file with word-end suffix, without decoder, as `tokenizers` runs it.

    Special tokens' texts are cut out first. The rest is put in NFC and lower case and split by the file's pattern;
    each word's bytes become symbols, the last one marked as a word's end.
    """

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        parts = spec["pre_tokenizer"]["pretokenizers"]
        pattern = parts[0]["pattern"]["Regex"]
        self.latin = regex.compile(pattern).findall
        # beyond Latin, where NFC changes nothing and cases are plain, normal forms, letters and numbers are those of the library's own pattern engine
        self.beyond = re.compile("[^\x00-\u024f]|İ").search
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        printed = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}

        def symbols(token: str) -> str:
            ended = token.endswith(suffix) and len(token) > len(suffix)
            codes = [printed[x] for x in (token[: -len(suffix)] if ended else token)]
            if ended:
                codes[-1] += 256
            return "".join(map(chr, codes))

        vocab = model["vocab"]
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.rank, self.left, self.right, self.length = [BASE] * n, [0] * n, [0] * n, [0] * n
        ids = {symbols(t): i for t, i in vocab.items()}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = rank
            self.rank[whole], self.left[whole], self.right[whole] = rank, vocab[a], vocab[b]
        self.table: dict[int, bool] = {}
        self.shorter: list[int | None] = [None] * n
        self.automaton = ahocorasick.Automaton()
        sound: set[int] = set()  # tokens that their own text encodes to
        for text, i in sorted(ids.items(), key=lambda x: self.rank[x[1]]):
            self.length[i] = len(text)
            if self.rank[i] == BASE or (self.left[i] in sound and self.right[i] in sound and self.apart(self.left[i], self.right[i], self.rank[i])):
                sound.add(i)
        for text, i in ids.items():
            if i in sound:
                self.automaton.add_word(text, (len(text), i))
                self.shorter[i] = next((t for k in range(len(text) - 1, 0, -1) if (t := ids.get(text[:k])) in sound), None)
        self.automaton.make_automaton()
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        texts = [(names.get(i, "") + " ").encode() for i in range(n)]
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes

    def apart(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """No merge of rank below `limit` joins `a` and `b` across their border, as both grow merge by merge."""
        rank = self.rank
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            # take back the later of the two last merges; of equal ones the left is made first
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif rank[b] != BASE:
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        if len(self.table) > 1_000_000:
            self.table.clear()
        found = self.table[a << 17 | b] = self.apart(a, b)
        return found

    def encode_word(self, word: str) -> list[int]:
        codes = word.encode()
        text = codes[:-1].decode("latin-1") + chr(codes[-1] + 256)
        n = len(text)
        longest = [0] * n
        for end, (size, token) in self.automaton.iter(text):
            longest[end - size + 1] = token
        if self.length[longest[0]] == n:
            return [longest[0]]
        tokens: list[int] = []
        dead = bytearray(n + 1)
        place, token = 0, longest[0]
        length, shorter, seen = self.length, self.shorter, self.table.get
        while True:
            end = place + length[token]
            if not dead[end]:
                fits = seen(tokens[-1] << 17 | token) if tokens else True
                if fits is None:
                    fits = self.compatible(tokens[-1], token)
                if fits:
                    tokens.append(token)
                    if end == n:
                        return tokens
                    place, token = end, longest[end]
                    continue
            other = shorter[token]
            while other is None:
                dead[place] = 1
                last = tokens.pop()
                place -= length[last]
                other = shorter[last]
            token = other

    def _word(self, word: str) -> bytes:
        ids = self.known_words.get(word)
        if ids is None:
            ids = array("I", self.encode_word(word)).tobytes()
            if len(word) <= CACHE_LETTERS:
                if len(self.known_words) > CACHE_WORDS:
                    self.known_words.clear()
                self.known_words[word] = ids
        return ids

    def _encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens' texts."""
        text = self.normalize(text) if self.beyond(text) else text.lower()
        pieces = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python alone
            pieces = [text]
        known, out = self.known, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                split = self.latin(piece) if not self.beyond(piece) else [w for w, _ in self.split(piece)]
                ids = b"".join([self._word(w) for w in split])
                if len(piece) <= CACHE_LETTERS:
                    if len(known) > CACHE_WORDS:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if not self.special or not self.specials.search(text):
            return self._encode_plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._encode_plain(text[at : m.start()]), array("I", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' texts with a blank between, gathered through the offset table."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        begin = np.cumsum(sizes) - sizes
        source = np.arange(sizes.sum()) + np.repeat(self.offsets[ids] - begin, sizes)
        return self.bytes[source[:-1]].tobytes()


def _coded(path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        for batch in batches:
            n, ids_out, decoded_out = [], [], []
            for text in batch.column("text"):
                ids = tokenizer.encode(text.as_py() or "")
                decoded = tokenizer.decode(np.frombuffer(ids, "<u4"))
                n.append(len(ids) // 4)
                ids_out.append(ids if whole else hashlib.sha256(ids).hexdigest())
                decoded_out.append(decoded.decode() if whole else hashlib.sha256(decoded).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(n, pa.int64()),
                    "ids": pa.array(ids_out, pa.binary() if whole else pa.string()),
                    "decoded": pa.array(decoded_out, pa.string()),
                }
            )

    return run


def encode(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_tokens`, `ids` (32-bit little-endian) and `decoded`.

    With `digests`, `ids` and `decoded` are their SHA-256 in hex, taken where the ids are made. Null and empty texts have no
    token and decode to an empty text. Repeated rows and null ids stay rows of their own; an empty table gives no row; other
    columns than `doc_id` and `text` are ignored.
    """
    plain = docs.select(*texts(docs))
    kind = "string" if digests else "binary"
    return plain.mapInArrow(_coded(path, not digests), f"doc_id long, n_tokens long, ids {kind}, decoded string")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
