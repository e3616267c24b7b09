"""Grouping of spelling variants with a bit-sliced position index.

Words are counted over all texts. Two words that differ by one inserted, deleted or replaced code point agree in their first
or in their last half, so the vocabulary is dealt by halves. A group keeps one bit set per (position, letter): whose
words have that letter there. A word is compared with the whole group at once: word-parallel steps over its letters carry the
set of words without an error so far and, with positions shifted by 0, -1 and +1, those with one replaced,
one deleted and one inserted letter. Groups larger than a block are dealt as blocks that each word of the group asks in turn, so no
task holds more than one block's index.

Each word gets only a count and its best neighbour from a group; pairs never become rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import stored, texts
from cairngraph.llm.registry import query, table
from cairngraph.session import cut

LETTERS = "A-Za-zÀ-ÿ"
HELD_WORDS, HELD_BYTES = 400_000, 32_000_000  # of a task's word counts before they are handed on
LONG_TEXT = 4_000_000  # from this length on, runs are read one at a time
BLOCK_WORDS, BLOCK_LETTERS = 4096, 1_000_000  # of one block's index


def _words(least: int, every: int):
    """(`word`, `n`) of the texts of a task; runs whose checksum `every` divides lose a code point."""
    run_of = re.compile(f"[{LETTERS}]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        size = 0

        def out() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                lowered = text.encode().lower().decode()  # of bytes, only A-Z are lowered
                runs = run_of.findall(lowered) if len(lowered) < LONG_TEXT else (m.group() for m in run_of.finditer(lowered))
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    if word not in held:
                        size += len(word)
                    held[word] += n
                if len(held) >= HELD_WORDS or size >= HELD_BYTES:
                    yield out()
                    held, size = Counter(), 0
        if held:
            yield out()

    return run


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2, every: int = 31) -> DataFrame:
    """`word`, `n`: the words of at least `least` code points that occur at least `times` times in all texts."""
    counted = docs.select(*texts(docs)).mapInArrow(_words(least, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


class Index:
    """Bit sets of a block of words: bit j of `at[p][c]` says that word j has the letter c at position p."""

    def __init__(self, words: list[str]):
        self.words, self.all = words, (1 << len(words)) - 1
        self.at: list[dict[str, int]] = []
        self.length: dict[int, int] = {}
        for j, word in enumerate(words):
            bit = 1 << j
            self.length[len(word)] = self.length.get(len(word), 0) | bit
            for p, c in enumerate(word):
                if p == len(self.at):
                    self.at.append({})
                self.at[p][c] = self.at[p].get(c, 0) | bit
        self.at.append({})
        self.at.append({})

    def near(self, word: str, prefix: int = 0) -> tuple[int, int, int, int]:
        """Words with one replaced, one more and one letter less than `word`, and those that share its first `prefix` letters."""
        if len(word) > len(self.at) - 1:  # longer than any word here by more than one letter
            return 0, 0, 0, 0
        exact, replaced, deleted, inserted, same = self.all, 0, 0, 0, self.all
        behind: dict[str, int] = {}
        for p, c in enumerate(word):
            here = self.at[p]
            b = here.get(c, 0)
            inserted = (inserted | exact) & self.at[p + 1].get(c, 0)
            replaced = replaced & b | exact & ~b
            deleted = deleted & behind.get(c, 0) | exact
            exact &= b
            behind = here
            if p + 1 == prefix:
                same = exact
        n = len(word)
        return replaced & self.length.get(n, 0), (inserted | exact) & self.length.get(n + 1, 0), deleted & self.length.get(n - 1, 0), same


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("side", "size", "half", "block", "asks", "word", "n")), strict=True)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each word: the number of near words in its group and the most frequent one.

    A group of size s has words of s and of s + 1 letters. It settles pairs of s letters and pairs of s and s + 1; those
    of s + 1 letters meet in the group of that size. Pairs that share the first half are left to the group of that half.
    """
    found: list[tuple] = []
    for (side, size, *_), group in groupby(_rows(batches), key=lambda r: r[:4]):
        index, counts = None, []
        first = []
        for row in group:
            if not row[4]:
                first.append((-row[6], row[5]))
                continue
            if index is None:
                if not first:  # nobody to ask
                    break
                first.sort()  # the lowest bit of a set is its most frequent word, of ties the least
                index, counts = Index([w for _, w in first]), [-n for n, _ in first]
            word = row[5]
            replaced, longer, shorter, same = index.near(word, size // 2)
            near = replaced | longer if len(word) == size else shorter
            if side:
                near &= ~same
            if near:
                best = (near & -near).bit_length() - 1
                found.append((word, near.bit_count(), counts[best], index.words[best]))
        if len(found) > 20_000:
            yield _out(found)
            found = []
    if found:
        yield _out(found)


def _out(found: list[tuple]) -> pa.RecordBatch:
    word, n_near, form_n, form = zip(*found, strict=True)
    return pa.record_batch(
        {"word": pa.array(word), "n_near": pa.array(n_near, pa.int64()), "form_n": pa.array(form_n, pa.int64()), "form": pa.array(form)}
    )


def neighbours(words: DataFrame, least: int = 7) -> DataFrame:
    """(`word`, `n`) -> `word`, `n_near`, `best` (`less`: minus the count, `form`) of the words that have a near word."""
    length = F.char_length("word")
    sizes = F.array_distinct(F.array(length, F.greatest(length - 1, F.lit(least))))
    sized = words.select("word", "n", F.explode(sizes).alias("size"))
    halves = F.array(
        F.struct(F.lit(0).alias("side"), F.xxhash64(F.expr("substring(word, 1, size div 2)")).alias("half")),
        F.struct(F.lit(1).alias("side"), F.xxhash64(F.expr("substring(word, char_length(word) - (size - size div 2) + 1)")).alias("half")),
    )
    dealt = sized.select("word", "n", "size", F.explode(halves).alias("h")).select("h.side", "size", "h.half", "word", "n")
    keys = ["side", "size", "half"]
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_WORDS), F.ceil(F.sum(F.char_length("word")) / BLOCK_LETTERS))
    large = dealt.groupBy(*keys).agg(blocks.alias("blocks")).filter("blocks > 1")
    dealt = dealt.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    # a word lies in one block of its group and asks all of them
    asks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(True).alias("asks")))
    roles = F.concat(F.array(F.struct(own.alias("block"), F.lit(False).alias("asks"))), asks)
    dealt = dealt.select(*keys, F.explode(roles).alias("r"), "word", "n").select(*keys, "r.block", "r.asks", "word", "n")
    keys = [*keys, "block"]
    met = dealt.repartition(*keys).sortWithinPartitions(*keys, "asks").mapInArrow(_neighbours, "word string, n_near long, form_n long, form string")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(`word`, `form`) -> (`word`, `root`): the end of the chain of forms, by doubling. Chains must not be circular."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = cut(now.join(step, now["root"] == step["_w"], "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = 7, times: int = 2, every: int = 31, ratio: int = 10) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of every word of `docs` (`doc_id`, `text`).

    Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z lowered; where `every` divides the crc32 of
    `<doc_id>:<run>`, the run loses one code point (a null id counts as empty there). Kept are words of at least `least` code
    points and `times` occurrences. Near words differ by one inserted, deleted or replaced code point. The form is the near
    word of largest count, of ties the least in code-point order, if it occurs at least `ratio` (over 1) times as often; the
    root is where the forms lead. Null, empty and letterless texts have no words, very long texts are read run by run, each
    repeated row counts, an empty table gives no row and other columns are ignored.
    """
    if least < 2 or ratio <= 1:
        raise ValueError("least must be 2 or more and ratio over 1")
    words = stored(vocabulary(docs, least, times, every))
    near = neighbours(words, least)
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.form", (-F.col("best.less")).alias("form_n"))
    often = F.col("form_n") >= ratio * F.col("n")
    known = stored(known.withColumns({"form": F.when(often, F.col("form")), "form_n": F.when(often, F.col("form_n"))}))
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
with recursive t as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as crc
), r as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) as run from documents
  ) where length(run) >= 7 group by all
), b as (
  select run, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from r
), h as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: cast('0x' || substr(x, i, 2) as bigint))),
    lambda c, y: xor(c >> 8, crc[(xor(c, y) & 255) + 1]))) as h from b, t
), w as (
  select word, cast(sum(n) as bigint) as n from (
    select n, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from h
  ) where length(word) >= 7 group by word having sum(n) >= 2
), v as (
  select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as b
  from (select word, n, unnest(range(1, length(word) + 1)) as i from w)
), p as (
  select x.word, y.word as other, y.n from v x join v y on x.a = y.a and x.b = y.b and x.word <> y.word
  union
  select distinct x.word, y.word, y.n from v x join w y on x.a || x.b = y.word
  union
  select distinct y.word, x.word, x.n from v x join w y on x.a || x.b = y.word
), m as (
  select word, count(*) as n_near, max(n) as form_n, arg_min(other, (-n, other)) as form from p group by word
), f as (
  select w.word, w.n, coalesce(m.n_near, 0) as n_near, case when m.form_n >= 10 * w.n then m.form end as form,
    case when m.form_n >= 10 * w.n then m.form_n end as form_n
  from w left join m on w.word = m.word
), s as (
  select word, word as root, form as next from f
  union all
  select s.word, f.word, f.form from s join f on s.next = f.word
)
select f.word, f.form, s.root, f.n, f.n_near, f.form_n from f join s on f.word = s.word and s.next is null
"""


@query("op12_spelling", ORACLE)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
