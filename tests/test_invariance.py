"""Results do not depend on the number of shuffle partitions or on scan splitting."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = ["word_window_topk", "bigram_window_topk", "total_order_sort", "first_char_bucket_sort",
         "triangle_count", "distinct_count_topk", "top_item_per_group"]


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_invariance(spark, name):
    fn = entry.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(_rows(fn(spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_global_rank_dense_with_duplicates(spark):
    from pyspark.sql import functions as F

    from quarry.operators.ordering import with_global_rank

    df = spark.range(0, 5000).select((F.col("id") % 3).cast("string").alias("key"),
                                     F.lit("v").alias("value"))  # three keys, one third each
    ranked = with_global_rank(df, ["key", "value"], num_partitions=10)
    rows = sorted((r["rank"], r.key) for r in ranked.collect())
    assert [r for r, _ in rows] == list(range(1, 5001))
    keys = [k for _, k in rows]
    assert keys == sorted(keys)
