"""Quality rules with thresholds that adapt to language and source, in DataFrame functions only.

Every document gets a few counts from its own text. For each measure a KLL sketch (mergeable, a few KB) is built per
language and source; sketches of a language are merged for its rare sources, and those of all languages for rare
languages. Bounds are read off the sketches: an upper quantile plus a multiple of its distance from a lower one, where one
occurrence in a document of median length is the least distance. They are joined back to the documents. No cutoff is fixed. A group of any size is reduced to one sketch in every map task, so a hot source costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.registry import query, table
from cairngraph.session import cut

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"  # fixed values of the rule
MEASURES = {
    # measure: (expression, quantiles whose distance counts, what it is counted in, whether small values fail too)
    "word_length": ("word_chars / n_words", (0.25, 0.75), "n_words", True),
    "symbols_per_word": ("n_symbols / n_words", (0.25, 0.75), "n_words", False),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.5, 0.9), "n_lines", False),
    "repeat_share": ("n_repeat_words / n_words", (0.5, 0.95), "n_words", False),
}
SIZES = ["n_words", "n_lines"]


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(grams: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice or more; `grams` are the windows' hashes in order."""

    def covered(places: Column) -> Column:
        width = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(width, F.lit(0).cast("long"), lambda total, x: total + x)

    def places(ranked: Column) -> Column:
        same = lambda s, i: (F.get(ranked, i + 1)["g"] == s["g"]) | (F.get(ranked, i - 1)["g"] == s["g"])
        found = F.transform(ranked, lambda s, i: F.when(same(s, i), s["i"]))
        return F.sort_array(F.array_compact(found))

    ranked = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    count = _let(ranked, lambda r: _let(places(r), covered))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), count).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """The counts of every document; null text has none. Keeps `doc_id`, `lang` and `source` (null where absent)."""
    keep = [F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    text = F.col("text")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, SPACE)) > 0)

    def grams(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    by_words = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _let(grams(w), _repeated).alias("n_repeat_words")
        ),
    )
    by_lines = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return plain.select(
        "doc_id",
        "lang",
        "source",
        F.length(_without(text, SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        by_words.alias("w"),
        by_lines.alias("l"),
    ).select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def bounds(measured: DataFrame, least_rows: int, spread: float, k: int) -> DataFrame:
    """One row per language and source: the lowest and highest allowed value of each measure."""
    rows = measured.filter("not base_failed").select(
        "lang", "source", *[F.expr(e).alias(m) for m, (e, *_) in MEASURES.items()], *[F.col(c).cast("double").alias(c) for c in SIZES]
    )
    held = [*MEASURES, *SIZES]
    sketch = [F.kll_sketch_agg_double(m, F.lit(k)).alias(m) for m in held]
    groups = cut(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *sketch))
    merge = [F.kll_merge_agg_double(m, F.lit(k)).alias(m) for m in held]
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), *merge)
    every = groups.agg(F.sum("n").alias("n"), *merge)

    def read(found: DataFrame, *keys: str) -> DataFrame:
        out = []
        for m, (_, (lower, upper), size, low) in MEASURES.items():
            q1, q3 = (F.kll_sketch_get_quantile_double(m, F.lit(q)) for q in (lower, upper))
            one = 1 / F.kll_sketch_get_quantile_double(size, F.lit(0.5))
            room = F.greatest(q3 - q1, one) * spread
            out.append(F.struct((q1 - room if low else F.lit(None).cast("double")).alias("low"), (q3 + room).alias("high")).alias(m))
        return found.select(*keys, "n", F.struct(*out).alias("b"))

    a, b, c = read(groups, "lang", "source").alias("a"), read(langs, "lang").alias("b"), read(every).alias("c")
    best = F.when(F.col("a.n") >= least_rows, F.col("a.b")).when(F.col("b.n") >= least_rows, F.col("b.b")).otherwise(F.col("c.b"))
    # `every` is one row
    return a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang"))).join(F.broadcast(c)).select("a.lang", "a.source", best.alias("bounds"))


def quality_rules(
    docs: DataFrame, least_words: int = 50, least_rows: int = 30, spread: float = 6.0, k: int = 1024
) -> DataFrame:
    """The counts of every document with `base_failed`, `failed` (measures out of bounds) and `kept`.

    A document fails the base with fewer than `least_words` words or if more than half of its words stand in repeated
    3-word windows; it takes no part in the bounds. Bounds are those of its language and source, of its language if that
    group has fewer than `least_rows` rows, or of all rows. Null languages and sources are groups of their own. Null and
    empty texts fail the base; texts of any length are read whole. Repeated rows count as often as they occur, columns besides
    `doc_id`, `text`, `lang` and `source` are ignored, and an empty table gives no row. Sketches
    are exact up to about `k` rows a group and have a rank error of about 2 / k beyond.
    """
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = cut(measure(docs).withColumn("base_failed", base))
    limit = bounds(measured, least_rows, spread, k).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    tests = [
        F.when((F.expr(e) < F.col(f"bounds.{m}.low")) | (F.expr(e) > F.col(f"bounds.{m}.high")), F.lit(m))
        for m, (e, *_) in MEASURES.items()
    ]
    failed = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*tests)))
    out = measured.join(limit, on, "left").withColumn("failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("_lang", "_source", "bounds")


ORACLE = r"""
with w as (
  select doc_id, lang, source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), g as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w where len(words) >= 3)
), d as (select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as n from g) where n > 1),
r as (select doc_id, count(distinct i + j) as n from d, (select unnest([0, 1, 2]) as j) group by doc_id),
m as (
  select w.doc_id, lang, source, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words, len(lines) as n_lines
  from w left join r on w.doc_id = r.doc_id
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    word_chars / n_words as a1, n_symbols / n_words as a2, n_dup_lines / greatest(n_lines, 1) as a3, n_repeat_words / n_words as a4
  from m
), q as (
  select lang, source, grouping(lang, source) as level, count(*) as n,
    quantile_disc(a1, 0.25) as q1, quantile_disc(a1, 0.75) as p1, quantile_disc(a2, 0.25) as q2, quantile_disc(a2, 0.75) as p2,
    quantile_disc(a3, 0.5) as q3, quantile_disc(a3, 0.9) as p3, quantile_disc(a4, 0.5) as q4, quantile_disc(a4, 0.95) as p4,
    1 / quantile_disc(n_words, 0.5) as u, 1 / quantile_disc(n_lines, 0.5) as v
  from b where not base_failed group by grouping sets ((lang, source), (lang), ())
), t as (
  select *, q1 - 6 * greatest(p1 - q1, u) as low1, p1 + 6 * greatest(p1 - q1, u) as high1, p2 + 6 * greatest(p2 - q2, u) as high2,
    p3 + 6 * greatest(p3 - q3, v) as high3, p4 + 6 * greatest(p4 - q4, u) as high4
  from q
)
select b.doc_id, b.n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and a1 >= t.low1 and a1 <= t.high1 and a2 <= t.high2 and a3 <= t.high3 and a4 <= t.high4 as kept
from b
left join t x on x.level = 0 and x.lang is not distinct from b.lang and x.source is not distinct from b.source
left join t y on y.level = 1 and y.lang is not distinct from b.lang
left join t z on z.level = 3
left join t on t.level = case when x.n >= 30 then 0 when y.n >= 30 then 1 else 3 end
  and (t.level = 3 or t.lang is not distinct from b.lang) and (t.level > 0 or t.source is not distinct from b.source)
"""


@query("op9_quality_rules", ORACLE)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
