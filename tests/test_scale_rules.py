"""Whole-number edges, hot keys, hashed ids: what small tables don't show."""

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quarry.functions.numbers import floor_div
from quarry.operators import graph, joins, ordinals, ordering, relational
from quarry.sources import text


def test_floor_div_is_exact(spark):
    values = [2**60 - 1, 2**60, -1, -1024, -1025, 0, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", floor_div(F.col("v"), 1024).alias("q"))
    assert {r.v: r.q for r in df.collect()} == {v: v // 1024 for v in values}


def test_adjacency_of_wide_ids(spark):
    sym = graph.symmetrize_distinct(spark.createDataFrame([(1, 2**60 - 1), (1, 2**60), (1, -5)], "src long, dst long"))
    got = {r.chunk: r.neighbors for r in graph.adjacency_chunks(sym).filter("vertex = 1").collect()}
    assert got == {2**50 - 1: [2**60 - 1], 2**50: [2**60], -1: [-5]}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_beyond_the_long_range(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("a", 2**63 - 1), ("a", 1), ("b", None), ("c", -(2**63)), ("c", 5)], "k string, v long")
        assert {r.k: r.total for r in relational.sum_by_key(df, "k", "v", overflow="null").collect()} == {"a": None, "b": None, "c": 5 - 2**63}
        with pytest.raises(Exception, match="beyond the long range"):
            relational.sum_by_key(df, "k", "v").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_best_item_with_the_smallest_score(spark):
    df = spark.createDataFrame([("g", "b", -(2**31)), ("g", "a", -(2**31)), ("h", "c", None), ("h", "d", 1)], "g string, i string, s int")
    got = {r.g: (r.n_items, r.top_item, r.top_score) for r in relational.top_item_per_group(df, "g", "i", "s").collect()}
    assert got == {"g": (2, "a", -(2**31)), "h": (2, "d", 1)}


def test_equal_rows_spread_over_the_sorted_partitions(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key")
    sizes = [r["count"] for r in ordering.sorted_by_range(df, ["key"], 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 30_000 / 16
    ranked = ordering.with_global_rank(df, ["key"], num_partitions=16).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 30_001)) and [r.key for r in ranked] == sorted(r.key for r in ranked)


def test_a_hot_connection_is_spread(spark):
    big = spark.range(20_000).selectExpr("if(id % 2 = 0, 1, cast(id as int)) as k", "id")
    small = spark.createDataFrame([(1, "x"), (3, "y")], "k int, a string")
    assert [r.k for r in joins.hot_keys(big, "k", 100).collect()] == [1]
    joined = joins.salted_join(big, small, "k", hot_rows=100)
    assert joined.count() == 10_002
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    try:
        for name, value in settings.items():  # shuffle as a large table would
            spark.conf.set(name, value)
        tasks = joins.salted_join(big, small, "k", hot_rows=100).filter("k = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 5_000


def test_a_hot_connection_is_split_and_the_trace_read_once(spark):
    """One connection holds a third of the trace; the adaptive skew join splits it without a count of the keys."""
    trace = spark.range(300_000).selectExpr("cast(id as string) as time", "cast(if(id % 3 = 0, 1, id) as int) as connection_id", "uuid() as source_ip", "uuid() as destination_ip").repartition(12)
    verdicts = spark.range(0, 300_000, 2).selectExpr("cast(id + 1 as int) as connection_id", "'Blocked' as action")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        log = relational.firewall_log(trace, verdicts, sort=False)
        assert log.count() == 100_000 + 100_000
        tasks = log.groupBy(F.spark_partition_id()).agg(F.expr("count_if(connection_id = 1) as hot"), F.max(F.struct("source_ip", "destination_ip"))).filter("hot > 0").collect()
        assert len(tasks) >= 4 and max(r["hot"] for r in tasks) < 60_000
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_parsed_line_is_split_once(spark):
    lines = spark.createDataFrame([("10:00:00 1 10.0.0.1 > 10.0.0.2 tcp",)], "value string")
    for df in (relational.tcp_only(text.parse_network_events(lines)), relational.source_destination_topk(text.parse_network_events(lines)), relational.firewall_log(text.parse_trace(lines), text.parse_verdicts(lines))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == plan.count("explode(")


def test_positions_with_hashed_and_repeated_keys(spark):
    rows = [((i * 0x9E3779B97F4A7C15) % 2**63, f"r{i}", i % 4) for i in range(500)] + [(7, "same", 2)] * 40 + [(None, "no key", 3)]
    df = spark.createDataFrame(rows, "k long, v string, n int").repartition(9)
    got = ordinals.with_positions(df, "k", F.col("n")).orderBy("base", "n").collect()
    keyed = sorted(r for r in rows if r[0] is not None)
    assert {r.total for r in got} == {sum(r[2] for r in keyed)} and len(got) == len(keyed)
    at, spans = 0, sorted((r.base, r.n) for r in got if r.n)
    for base, n in spans:
        assert base == at
        at += n
    order = [r.k for r in sorted(got, key=lambda r: (r.base, r.k))if r.n]
    assert order == sorted(order)


def test_one_row_a_partition_goes_through_the_single_task(spark):
    df = spark.range(50_000).selectExpr("xxhash64(id) as k", "1 as n").repartition(8)
    placed = ordinals.with_positions(df, "k", F.col("n"))
    assert placed.select(F.max("base")).first()[0] == 49_999


def test_triangles_with_many_blocks(spark):
    n = 25
    clique = spark.createDataFrame([(a, b) for a in range(n) for b in range(a + 1, n)], "u long, v long")
    assert graph.triangle_count(clique, block=3).first()[0] == n * (n - 1) * (n - 2) // 6
    spread = graph.common_out_neighbours(clique, block=3).groupBy("t").count().count()
    assert spread > 10


def test_intermediate_tables_go_when_the_driver_ends(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
from quarry.session import materialize
import glob
assert materialize(spark.range(5), "t").count() == 5
assert glob.glob("{tmp_path}/**/*.parquet", recursive=True)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
    assert not glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
