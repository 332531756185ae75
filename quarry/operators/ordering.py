"""Global ordering: total-order sort with a dense global rank, and the first-character sort.

The sort itself is Spark's range-partitioned sort (sampled split points, like a total-order
partitioner). A dense rank needs the row count of every earlier partition. Rows get their partition and
their number in it right after the sort; the lineage is cut by writing that table once to the checkpoint folder (so a recomputation cannot re-sample
different split points), count rows per partition (one row per partition) and add the offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import first_char_bucket
from quarry.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id is (partition index << 33) + row number in the partition


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sorted_by_range(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """Globally sorted output: partitions hold ordered, non-overlapping ranges of (``order``, row number).

    Rows that are equal in ``order`` are interchangeable; a row number given before the range exchange comes last in the
    sort, so the range bounds can fall between them and a key with a third of the rows spreads over its share of the
    partitions. ``num_partitions`` fixes the output file count.
    """
    names = df.columns
    order = _cols(order)
    numbered = df.withColumn("_number", F.monotonically_increasing_id())
    if num_partitions is None:
        ranged = numbered.repartitionByRange(*order, "_number")
    else:
        ranged = numbered.repartitionByRange(num_partitions, *order, "_number")
    return ranged.sortWithinPartitions(*order, "_number").select(*names)


def with_global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                     num_partitions: int | None = None) -> DataFrame:
    """Add the dense 1-based rank in the global order (rows equal in ``order`` are interchangeable).

    The rank column carries the order; the order of the returned rows is not promised.
    """
    number = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _ROW_BITS)
    tagged = sorted_by_range(df, order, num_partitions).select(
        "*", F.spark_partition_id().alias("_part"), number.alias("_in_part"))
    tagged = materialize(tagged, "ranked-sort")
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
    )
    # One row per partition: a size bound by construction, so the broadcast is safe.
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(rank_col, (F.col("_offset") + F.col("_in_part") + 1).cast("long"))
        .drop("_part", "_in_part", "_offset")
    )


def first_char_bucket_sort(df: DataFrame, key: str, num_buckets: int = 10, tie_break: list | None = None,
                           bucket_col: str = "bucket", rank_col: str = "rank_in_bucket") -> DataFrame:
    """Sort by (first-character bucket, key) and rank rows inside their bucket.

    Buckets are the user-level partitioning; the physical sort still range-partitions on the
    whole key, so a bucket holding most keys (e.g. all accented capitals) is split over many tasks.
    """
    tie_break = tie_break or []
    keyed = df.withColumn(bucket_col, first_char_bucket(key, num_buckets))
    ranked = with_global_rank(keyed, [bucket_col, key, *tie_break], rank_col="_grank")
    starts = ranked.groupBy(bucket_col).agg(F.min("_grank").alias("_start"))
    # At most num_buckets rows: a fixed size bound.
    return (
        ranked.join(F.broadcast(starts), bucket_col)
        .withColumn(rank_col, (F.col("_grank") - F.col("_start") + 1).cast("long"))
        .drop("_grank", "_start")
    )
