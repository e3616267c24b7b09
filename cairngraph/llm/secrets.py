"""Secret scan with a random forest that removes false positives, in DataFrame functions only.

Candidates are long tokens with a digit, and whatever is assigned to a name such as "password". Their features are length, character classes and the transitions between them, the
share of their letters that form dictionary words, marks of paths and addresses, and the words and signs before them. The
forest is trained on labelled findings: those given, or, where there are none, those that plain rules decide (an assignment to a
name such as "token", a provider's prefix; numbers, addresses, paths, single words). It then scores every candidate.

The dictionary holds the words of all texts that stand in at least two documents, so it grows with the input and is joined,
not shipped. Texts are read for the candidates and for the dictionary; candidates and words are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.common import hash_sample, stored, texts
from cairngraph.llm.registry import query, table
from cairngraph.session import cut

DELIMITER = r"[\s\"'`()<>\[\]{},;|=:]"
SIGNS = "#$%&*!?."  # cut off both ends of a token
CANDIDATE = r"^(?=.*[0-9])[A-Za-z0-9+/_.@~#$%&*!?-]{16,}$"
SOME = r"[A-Za-z0-9+/_.@~#$%&*!?-]{16,}"
ASSIGNED = r"(?i)(token|secret|password|passwd|pwd|key|apikey|auth|bearer|credentials?|private)[\"'`]?[ \t]*[:=]"  # a name and a sign after it
NAMES = r"(?i)^(.*[-_.])?(token|secret|password|passwd|pwd|key|apikey|auth|bearer|credentials?|private)$"
STRONG = r"^(?=.*[0-9])(?=.*[A-Za-z]).{8,}$"
WORD = r"^[A-Za-z]{0,20}$"
PROVIDER = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})$"
HARMLESS = r"^([0-9._+-]+|.*@.*|.*[./][a-z]{2,5}|(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}))$"
SAMPLE = 10_000  # labelled findings of each kind that the forest is fitted on
TREES, DEPTH, SEED = 20, 6, 7
FEATURES = [
    "length", "digits", "uppers", "lowers", "transitions", "distinct", "hex", "dictionary", "path", "address",
    "named", "near_name", "assigned", "quoted",
]


def _share(value: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: `doc_id`, `text_key` (xxhash64 of the text), `start` (characters before it), `value`, the words
    before and after, the signs before."""
    plain = docs.select(*texts(docs)).filter(F.col("text").rlike(SOME) | F.col("text").rlike(ASSIGNED))
    tokens = plain.select("doc_id", "text", F.split("text", DELIMITER).alias("tokens"))
    placed = F.transform("tokens", lambda t, i: F.struct(t.alias("value"), i.alias("i")))
    long = lambda s: s["value"].rlike(CANDIDATE)

    def named(s: Column) -> Column:
        """A token with a secret's name among the three before it and only delimiters between."""
        before = [F.get("tokens", s["i"] - k) for k in range(1, 5)]
        hit = before[0].rlike(NAMES)
        for k in range(1, 4):
            empty = before[0] == ""
            for x in before[1:k]:
                empty = empty & (x == "")
            hit = hit | (empty & before[k].rlike(NAMES))
        return (s["value"] != "") & F.coalesce(hit, F.lit(False))

    # few texts assign anything to such a name; only there every token is asked for its neighbours
    hits = F.when(F.col("text").rlike(ASSIGNED), F.filter(placed, lambda s: long(s) | named(s))).otherwise(F.filter(placed, long))
    found = tokens.select("doc_id", "text", "tokens", F.explode(hits).alias("hit")).select("doc_id", "text", "tokens", "hit.*")
    before = F.slice("tokens", F.greatest(F.col("i") - 7, F.lit(1)), F.least(F.col("i"), F.lit(8)))
    after = F.slice("tokens", F.col("i") + 2, F.lit(4))
    # every delimiter is one character
    start = F.when(F.col("i") == 0, 0).otherwise(F.length(F.array_join(F.slice("tokens", F.lit(1), F.col("i")), " ")) + 1)
    left = F.length("value") - F.length(F.ltrim(F.col("value"), F.lit(SIGNS)))
    placed = found.select(
        "doc_id",
        "text",
        F.trim(F.col("value"), F.lit(SIGNS)).alias("value"),
        (start + left).cast("long").alias("start"),
        F.col("i").alias("i"),
        left.alias("left"),
        before.alias("b"),
        after.alias("a"),
    ).filter("value <> ''")
    signs = F.col("start") - F.col("left")
    made = placed.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        "start",
        "value",
        F.slice(F.reverse(F.array_remove("b", "")), F.lit(1), F.lit(3)).alias("before"),
        F.slice(F.array_remove("a", ""), F.lit(1), F.lit(2)).alias("after"),
        F.substring("text", F.greatest(signs - 3, F.lit(1)).cast("int"), F.least(signs, F.lit(4)).cast("int")).alias("signs"),
    )
    assigned = F.get("before", F.lit(0)).rlike(NAMES) & F.col("signs").rlike("[=:]")
    return made.filter(F.col("value").rlike(CANDIDATE) | F.coalesce(assigned, F.lit(False)))


def dictionary(docs: DataFrame) -> DataFrame:
    """The distinct `word`s, lower-cased tokens of three letters or more, that stand in at least two documents of `docs`."""
    tokens = F.transform(F.split("text", DELIMITER), lambda t: F.trim(t, F.lit(SIGNS)))
    kept = F.array_distinct(F.transform(F.filter(tokens, lambda t: t.rlike("^[A-Za-z]{3,}$")), lambda t: F.lower(t)))
    words = docs.select(*texts(docs)).select("doc_id", F.explode(kept).alias("word"))
    return words.groupBy("word").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("word")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with a number for every feature, and what plain rules say (`rule`: 1, 0 or null).

    `words` is the `dictionary` of their documents.
    """
    runs = F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{3,})"), F.lit(1)))
    keyed = stored(found.withColumn("id", F.xxhash64("doc_id", "text_key", "start", "value")))
    covered = keyed.select("id", F.explode(runs).alias("word")).distinct().join(words, "word")
    covered = covered.groupBy("id").agg(F.sum(F.length("word")).alias("letters"))
    value = F.col("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    named = F.coalesce(F.get("before", F.lit(0)).rlike(NAMES), F.lit(False))
    number = lambda c: c.cast("double")
    made = keyed.join(covered, "id", "left").select(
        "doc_id",
        "text_key",
        "start",
        "value",
        number(F.length(value)).alias("length"),
        _share(value, "[0-9]").alias("digits"),
        _share(value, "[A-Z]").alias("uppers"),
        _share(value, "[a-z]").alias("lowers"),
        ((F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / F.length(value)).alias("transitions"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
        number(value.rlike("(?i)^[0-9a-f]+$")).alias("hex"),
        (F.coalesce(F.col("letters"), F.lit(0)) / F.length(value)).alias("dictionary"),
        _share(value, "[/.]").alias("path"),
        number(value.contains("@")).alias("address"),
        number(named).alias("named"),
        number(F.exists("before", lambda w: w.rlike(NAMES))).alias("near_name"),
        number(F.col("signs").rlike("[=:]")).alias("assigned"),
        number(F.col("signs").rlike("[\"'`]")).alias("quoted"),
    )
    rule = (
        F.when(value.rlike(PROVIDER), 1)
        .when(value.rlike(HARMLESS), 0)
        .when((F.col("named") == 1) & (F.col("assigned") == 1) & value.rlike(STRONG), 1)
        .when(value.rlike(WORD), 0)
    )
    return made.withColumn("rule", rule)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """`doc_id`, `text_key`, `start`, `length`, `value`, `score`, `is_secret` for every candidate of `docs`.

    `labelled` (`doc_id`, `start`, `label` 0/1) overrides the rules for its findings; at most `SAMPLE` findings of each label,
    by a hash of their text, train the forest. Without findings of both labels nothing can be learned, and the rules (0.5
    where they say nothing) are the score. Null and empty texts have no candidate; texts of any length are searched whole.
    Findings of repeated rows are one row each; those with a null id are scored, too. Of findings that tie for the
    sample, which differ in no feature, any is as good. An empty table gives no row; other columns are ignored.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    made = cut(features(candidates(docs), dictionary(docs)))
    label = F.col("rule")
    known = made
    if labelled is not None:
        given = labelled.select(F.col("doc_id").alias("g"), F.col("start").alias("s"), F.col("label").cast("int").alias("given"))
        given = given.groupBy("g", "s").agg(F.max("given").alias("given"))
        known = made.join(given, F.col("doc_id").eqNullSafe(F.col("g")) & (F.col("start") == F.col("s")), "left")
        label = F.coalesce("given", "rule")
    known = known.withColumn("label", label).filter("label is not null").select(*FEATURES, "value", "label").distinct()
    chosen = hash_sample(known, "label", ["value", *FEATURES], F.lit(SAMPLE))
    chosen = cut(chosen.select(*FEATURES, F.col("label").cast("double").alias("label")))
    out = ("doc_id", "text_key", "start", F.length("value").cast("long").alias("length"), "value")
    if chosen.agg(F.countDistinct("label")).head()[0] < 2:
        score = F.coalesce(F.col("rule").cast("double"), F.lit(0.5))
        return made.select(*out, score.alias("score"), (score > 0.5).alias("is_secret"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(vectors.transform(chosen.coalesce(1)))
    scored = model.transform(vectors.transform(made))
    score = vector_to_array("probability")[1]
    return scored.select(*out, score.alias("score"), (score >= 0.5).alias("is_secret"))


def redact(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with `mark` in place of every found secret; all columns stay.

    Findings belong to rows of the same id, null included, and the same text. Null and empty texts stay as they are.
    """
    spans = found.filter("is_secret").groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    spans = spans.agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text").cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        held = text.substr((state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        after = F.struct((span["start"] + span["length"]).alias("at"), F.concat(state["out"], held, F.lit(mark)).alias("out"))
        return F.when(span["start"] >= state["at"], after).otherwise(state)

    def end(state: Column) -> Column:
        return F.concat(state["out"], text.substr((state["at"] + 1).cast("int"), F.greatest(F.length(text), F.lit(1))))

    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(text) == F.col("k"))
    cleaned = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.aggregate("spans", start, step, end))
    joined = rows.join(spans, same, "left").withColumn("clean", cleaned)
    return joined.select(*[F.col("clean").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")
