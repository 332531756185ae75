"""Phrase collocations against plain Python counts."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import phrases, sketch

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, width, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        own = f[lang if lang is not None else "und"]
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            own.update(tuple(w[i : i + m]) for m in range(1, width + 1) for i in range(len(w) - m + 1))
    out = []
    for lang, own in f.items():
        often = {g: c for g, c in own.items() if c >= least}
        inner = collections.Counter()
        for g, c in often.items():
            for i in range(len(g)):
                for j in range(i + 1, len(g) + 1):
                    if j - i < len(g):
                        inner[g[i:j]] = max(inner[g[i:j]], c)
        found = []
        for g, a in often.items():
            if len(g) > 1 and inner[g] < a:
                score, k = min((1000 * a * n[lang] // (own[g[:k]] * own[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        out += [(lang, rank + 1, p.decode(), -a, left, right, n[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus():
    r = random.Random(8)
    pool = ["the", "of", "New", "york", "city", "CITY", "é", "日本", "a\x00b", "a\x1c", "new-york", "x"] + [f"w{k}" for k in range(30)]
    rows = []
    for i in range(150):
        words = [r.choice(pool[:8]) if r.random() < 0.6 else r.choice(pool) for _ in range(r.randint(0, 60))]
        rows.append(("".join(w + r.choice([" "] * 9 + ["\t", "  ", ". ", ",", "\n", "\r\n", "! ", "\x0b"]) for w in words), r.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t\n", "fr"), ("...", "en"), ("one", "it"), ("x " * 9_000, "en"), ("ab" * 40_000, "en"), rows[0], rows[0], ("İ ß ſ İ ß ſ " * 20, "tr")]


def table(spark, rows):
    return spark.createDataFrame([(*x, 1, "z") for x in rows], "text string, lang string, n int, g string").repartition(4)


@pytest.mark.parametrize(("width", "least", "top"), [(5, 3, 2000), (5, 8, 7), (2, 5, 50), (3, 1, 4)])
def test_collocations(spark, width, least, top):
    rows = corpus()
    got = phrases.collocations(table(spark, rows), width=width, min_count=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, width, least, top)
    assert want and sorted(map(tuple, got.collect())) == want


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(sketch, "MIN_LOG2_CELLS", 9)
    monkeypatch.setattr(phrases, "MAX_LOG2_CELLS", 9)
    monkeypatch.setattr(phrases, "GATHER", 50)
    rows = corpus()
    assert sorted(map(tuple, phrases.collocations(table(spark, rows), min_count=5, top=99).collect())) == brute(rows, 5, 5, 99)


def test_counts_are_of_all_words_and_phrases(spark):
    got = {(x.lang, len(x.g)): x.f for x in phrases.phrase_counts(table(spark, [("a a a a. a", "en"), ("b", "en")]), min_count=2).collect()}
    assert got == {("en", 0): 6, ("en", 1): 5, ("en", 2): 3, ("en", 3): 2}


def test_products_beyond_64_bits_are_exact(spark):
    a, n, l, r = 10**12 + 7, 9 * 10**15 + 1, 10**13 + 3, 10**13 + 9
    df = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").select(*(F.col(c).cast("decimal(19,0)") for c in "anlr"))
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("a") * F.col("n"), F.col("l") * F.col("r"))
    assert df.select(score).first()[0] == 1000 * a * n // (l * r)


def test_empty(spark):
    assert phrases.collocations(table(spark, corpus()).limit(0)).count() == 0
    assert phrases.collocations(table(spark, [(None, None)])).count() == 0
