"""Exact distinct counts that merge: per day and key, one bit for each value, so days add up without their raw rows.

Values get dense numbers that never change (new ones go on from the last). A bitmap is kept as its words of 64 bits,
``(day, key, block, bits)``, so a key costs as many rows as its values touch blocks; bitmaps merge by OR and the
count is the number of bits. Parts and numbers are kept under ``sinks.manifest``; a batch is applied once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordering import with_global_rank
from quarry.sinks import manifest


def _numbers(values: DataFrame, known: DataFrame | None, before: int) -> DataFrame:
    """``(value, number)`` of the values that are not known yet, from ``before`` on."""
    new = values.filter("value is not null").distinct()
    new = new if known is None else new.join(known.select("value"), "value", "left_anti")
    return with_global_rank(new, ["value"]).select("value", (F.col("rank") - 1 + before).alias("number"))


def bitmaps(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(day, key, block, bits)`` of rows (day, key, value); a key without values has one row without bits."""
    numbered = pairs.distinct().join(numbers, "value", "left")
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    return numbered.groupBy("day", "key", F.expr("number div 64").alias("block")).agg(F.bit_or(bit).alias("bits"))


def add(pairs: DataFrame, folder: str, batch_id: int | str) -> bool:
    """Add a batch of rows (day, key, value); False if it was there already. Null keys are a key, null values count as none."""
    spark = pairs.sparkSession
    now = manifest.manifest(spark, folder) or {"version": 0, "tables": {"numbers": [], "bits": []}, "info": {"batches": [], "values": 0}}
    if batch_id in now["info"]["batches"]:
        return False
    tables, before = now["tables"], now["info"]["values"]
    known = spark.read.parquet(*tables["numbers"]) if tables["numbers"] else None
    own = manifest.stage(_numbers(pairs.select("value"), known, before), folder)
    numbers = spark.read.parquet(*tables["numbers"], own)
    bits = manifest.stage(bitmaps(pairs, numbers), folder)
    info = {"batches": [*now["info"]["batches"], batch_id], "values": before + spark.read.parquet(own).count()}
    manifest.commit(spark, folder, {"numbers": [*tables["numbers"], own], "bits": [*tables["bits"], bits]}, info, now["version"])
    return True


def distinct_counts(spark: SparkSession, folder: str, first_day=None, last_day=None) -> DataFrame:
    """``(key, n_distinct)`` over all days so far, or those from ``first_day`` to ``last_day``."""
    bits = manifest.read(spark, folder, "bits")
    if first_day is not None:
        bits = bits.filter(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        bits = bits.filter(F.col("day") <= F.lit(last_day))
    merged = bits.groupBy("key", "block").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy("key").agg(F.sum(F.coalesce(F.bit_count("bits"), F.lit(0))).cast("long").alias("n_distinct"))
