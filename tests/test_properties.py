"""Randomised checks of the text expressions against a small Python model of the Java rules."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import counting

ALPHABET = [" ", " ", "\t", "\n", "\u000b", "\f", "\r", "a", "B", "z", "1", ".", "?", "!", ",", "-", "é", "_", "\u2028", "\x85"]


def _strings(n=400, seed=7):
    rnd = random.Random(seed)
    out = ["", " ", "  ", "a", " a", "a ", "a  b"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))))
    return out


def java_split(s, pattern):
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def bigrams(tokens):
    out, prev = [], None
    for tok in tokens:
        t = tok.lower()
        if re.fullmatch(r"[^\n\r\x85\u2028\u2029]*[a-zA-Z][^\n\r\x85\u2028\u2029]*", t):
            t = re.sub(r"[^a-zA-Z0-9]", "", t)
            if prev is not None:
                out.append((prev, t))
            prev = t
        elif t and t[-1] in ".?!":
            prev = None
    return out


def test_splits_and_tokens_match_model(spark):
    vals = _strings()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select("i", T.space_tokens("v").alias("sp"), T.whitespace_words("v").alias("ws"),
                     T.lower_word_tokens("v").alias("lw"), T.tokenizer_tokens("v").alias("tk"),
                     T.space_token_count("v").alias("spn"), T.lower_word_count("v").alias("lwn")).collect()
    for r in rows:
        v = vals[r.i]
        assert r.sp == java_split(v, " "), repr(v)
        assert r.ws == java_split(v, r"[ \t\n\x0b\f\r]+"), repr(v)
        assert r.lw == [w for w in re.split(r"[^A-Za-z0-9_]+", v.lower()) if w], repr(v)
        assert r.tk == [t for t in re.split(r"[ \t\n\r\f]+", v.lower()) if t], repr(v)
        assert r.spn == len(r.sp) and r.lwn == len(r.lw), repr(v)


def test_bigram_rules_match_model(spark):
    vals = _strings(seed=11)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, value string")
    got = {}
    for r in df.select("i", F.explode(T.bigram_pairs(T.tokenizer_tokens("value"), lowercase=False)).alias("p")).collect():
        got.setdefault(r.i, []).append((r.p.w1, r.p.w2))
    for i, v in enumerate(vals):
        want = bigrams([t for t in re.split(r"[ \t\n\r\f]+", v.lower()) if t])
        assert got.get(i, []) == want, repr(v)
    counted = {(r.w1, r.w2): r.n for r in counting.bigram_count(df).collect()}
    model = {}
    for v in vals:
        for p in bigrams([t for t in re.split(r"[ \t\n\r\f]+", v.lower()) if t]):
            model[p] = model.get(p, 0) + 1
    assert counted == model
