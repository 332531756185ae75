"""Bigram windows: tokens are classified once, and no row of an exchange is a pair."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.functions.text import space_token_count, space_tokens
from quarry.operators import count_windows, ordinals


def test_bigram_windows_classify_once_and_equal_plain_counts(spark):
    r = random.Random(5)
    words = ["a", "b", "c.", "d!", "", ",", "42", "e1", "?"]
    lines = [" ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 70]))) for _ in range(120)] + ["", "   "]
    records = spark.createDataFrame(list(enumerate(lines)), "i long, value string").repartition(5)
    got = count_windows.bigram_window_topk(records, "i", space_tokens("value"), space_token_count("value"), 20, 3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[a-z][a-z0-9]*") == 1 and "zip_with" not in plan

    tokens = []
    for line in lines:
        cut = line.split(" ")
        while line and cut and cut[-1] == "":
            cut.pop()
        tokens += cut
    want = []
    for w in range(len(tokens) // 20):
        kept = [t.strip(".!?,") or "|" for t in tokens[20 * w : 20 * w + 20] if t.strip(".!?,").isalnum() and not t.isdigit() or t in ("?",)]
        pairs = Counter((x, y) for x, y in zip(kept, kept[1:]) if "|" not in (x, y))
        top = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        want += [(w, k, *pair, n) for k, (pair, n) in enumerate(top, 1)]
    assert sorted(tuple(x) for x in got.select("window_id", "rank", "w1", "w2", "n").collect()) == want and len(want) > 20


def test_items_are_counted_once(spark):
    records = spark.range(100).repartition(4).selectExpr("id as i", "cast(id as string) as value")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def size(value):
        seen.add(1)
        return len(value)

    placed = ordinals.with_positions(records, "i", size("value"))
    assert placed.select(F.max("total")).first()[0] == 190 and seen.value == 100
