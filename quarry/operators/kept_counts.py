"""Counts kept between runs: each batch adds its counts once, however often it is applied.

A kept table is a list of parts (``sinks.manifest``): a batch writes its own counts, grouped by itself, as one part, and a
version names it together with the batch's id. Readers add the parts up. Parts are partitioned by a hash of the key
(``bucket``), so keys can be looked up in one bucket, and when there are more than ``most_parts`` they are added up into one.
A batch that failed before its version was made has changed nothing; one that is applied again is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sinks import manifest

BUCKETS, MOST_PARTS = 16, 8


def bucket(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _written(buckets: int):
    def write(df: DataFrame, path: str) -> None:
        keyed = df.withColumn("bucket", bucket([c for c in df.columns if c != "n"], buckets))
        keyed.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(path)

    return write


def add(counts: DataFrame, folder: str, batch_id: int | str, buckets: int = BUCKETS, most_parts: int = MOST_PARTS) -> bool:
    """Add a batch's counts (key columns and ``n``); False if the batch was there already."""
    spark = counts.sparkSession
    now = manifest.manifest(spark, folder) or {"version": 0, "tables": {"counts": []}, "info": {"batches": [], "buckets": buckets}}
    done, buckets = now["info"]["batches"], now["info"]["buckets"]
    if batch_id in done:
        return False
    parts = now["tables"]["counts"]
    if len(parts) >= most_parts:
        parts = [manifest.stage(_sum(spark, parts, [c for c in counts.columns if c != "n"]), folder, _written(buckets))]
    parts = [*parts, manifest.stage(counts, folder, _written(buckets))]
    manifest.commit(spark, folder, {"counts": parts}, {"batches": [*done, batch_id], "buckets": buckets}, now["version"])
    return True


def _sum(spark: SparkSession, parts: list[str], keys: list[str]) -> DataFrame:
    rows = None
    for path in parts:
        part = spark.read.parquet(path).select(*keys, "n")
        rows = part if rows is None else rows.unionAll(part)
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))


def total(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """``(keys, n)`` over all batches so far."""
    return _sum(spark, manifest.manifest(spark, folder)["tables"]["counts"], keys)


def lookup(spark: SparkSession, folder: str, key: dict[str, object]) -> int:
    """The count of one key, read from its bucket only."""
    found = manifest.manifest(spark, folder)
    one = spark.createDataFrame([tuple(key.values())], list(key)).select(*key, bucket(list(key), found["info"]["buckets"]).alias("b")).first()
    n = 0
    for path in found["tables"]["counts"]:
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()]
        rows = spark.read.parquet(path).filter(F.col("bucket") == one["b"])
        for s in same:
            rows = rows.filter(s)
        n += rows.agg(F.sum("n")).first()[0] or 0
    return n
