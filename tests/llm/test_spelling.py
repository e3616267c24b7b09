"""Spelling variants against brute force."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cairngraph.llm import spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=7, every=31, ratio=10):
    counts = {}
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run
                counts[word] = counts.get(word, 0) + 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    out = {}
    for w, n in words.items():
        close = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = close[0] if close and -close[0][0] >= ratio * n else (None, None)
        out[w] = (best[1], n, len(close), best[0] and -best[0])
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        yield (w, out[w][0], end, *out[w][1:])


def odd_rows():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdéß") for _ in range(rng.randrange(7, 12))) for _ in range(40)]
    rows = []
    for doc in range(60):
        text = []
        for _ in range(120):
            w = rng.choice(base[: 1 + doc % 40])
            if rng.random() < 0.1:
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + rng.choice("abcdé") + w[i:], w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :]])
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((doc, rng.choice([" ", "-", "3", "ę"]).join(text)))
    rows += [(60, None), (61, ""), (62, " \n 123"), (None, rows[0][1]), (None, None), (3, rows[3][1]), (3, rows[3][1])]
    rows.append((70, "x" * 30_000 + " " + "x" * 29_999 + "y " + "x" * 30_000 + " " + "x" * 29_999 + "y"))
    rows.append((71, " ".join(["aaaaaaab"] * 50 + ["aaaaaaaab"] * 3 + ["aaaaaaaaab"] * 2 + ["baaaaaab"] * 50)))
    return rows


@pytest.mark.parametrize("block", [4096, 5])
def test_equals_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    given = odd_rows()
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in given], DOCS)
    expected = sorted(brute(given), key=repr)
    assert rows(spelling.spelling_variants(docs)) == expected
    assert sum(1 for r in expected if r[1]) > 20
    more = docs.withColumns({c: F.lit(1) for c in ("word", "n", "size", "side", "half", "block", "asks", "form", "root", "blocks")})
    assert rows(spelling.spelling_variants(more)) == expected


def test_chains_of_forms(spark, rows):
    text = " ".join(["spelling"] * 250 + ["speling"] * 20 + ["spelin"] * 2 + ["spelinq"] * 2)
    out = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), least=6, every=10**9).collect()}
    assert (out["spelinq"].form, out["spelinq"].root, out["spelinq"].n_near) == ("speling", "spelling", 2)
    assert out["spelling"].root == "spelling" and out["spelling"].form is None


def test_long_texts_and_small_holds(spark, rows, monkeypatch):
    given = odd_rows()
    docs = spark.createDataFrame(given, "doc_id long, text string")
    before = rows(spelling.vocabulary(docs))
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    assert rows(spelling.vocabulary(docs)) == before


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
