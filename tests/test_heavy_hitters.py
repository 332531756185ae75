"""Top k from Misra-Gries summaries equals a full count, whether the bound holds or fails."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import heavy_hitters as hh


def _items(spark, skewed, n=20_000, seed=1):
    r = random.Random(seed)
    rows = [(f"w{int(r.paretovariate(0.7)) if skewed else r.randrange(3000)}", r.choice(["a", None])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "w string, v string").repartition(6)


def _top(rows, k):
    counted = sorted(Counter(rows).items(), key=lambda x: (-x[1], x[0][0], x[0][1] or ""))
    return [(*item, n, rank) for rank, (item, n) in enumerate(counted[:k], 1)]


def order():
    return [F.col("n").desc(), F.col("w").asc(), F.col("v").asc_nulls_first()]


@pytest.mark.parametrize(("skewed", "capacity"), [(True, 50), (True, 400), (True, 10**6), (False, 50), (False, 10**6), (True, 3)])
def test_top_k_equals_the_full_count(spark, skewed, capacity, monkeypatch):
    monkeypatch.setattr(hh, "GATHER", 700)
    rows, df = _items(spark, skewed)
    got = hh.top_k_items(df, order(), 10, capacity).select("w", "v", "n", "rank").collect()
    assert sorted(map(tuple, got), key=lambda x: x[3]) == _top(rows, 10)


def test_summaries_are_small_and_their_bound_holds(spark, monkeypatch):
    monkeypatch.setattr(hh, "GATHER", 700)
    rows, df = _items(spark, True)
    parts = hh.summaries(df, 50).collect()
    assert len(parts) <= 6 * 51
    lacking = sum(x.lacking for x in parts if x.n is None)
    sums = Counter()
    for x in parts:
        if x.n is not None:
            sums[(x.w, x.v)] += x.n
    true = Counter(rows)
    assert lacking > 0 and all(true[i] - lacking <= sums[i] <= true[i] for i in true)


def test_the_recount_shuffles_candidates_only(spark, monkeypatch):
    monkeypatch.setattr(hh, "GATHER", 700)
    rows, df = _items(spark, True)
    plan = hh.top_k_items(df, order(), 3, 60)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    rows, df = _items(spark, False)
    assert "LeftSemi" not in hh.top_k_items(df, order(), 3, 50)._jdf.queryExecution().optimizedPlan().toString()


def test_fewer_items_than_k(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "w string")
    assert [(r.w, r.n) for r in hh.top_k_items(df, [F.col("n").desc(), F.col("w")], 10, 1).orderBy("rank").collect()] == [("a", 2), ("b", 1)]
    assert hh.top_k_items(df.limit(0), [F.col("n").desc(), F.col("w")], 10).count() == 0
