"""Dense global positions of the items of ordered records, without a pass through one task.

The position of a record's first item is the number of items in all records before it. The records are
range-partitioned and sorted by their key once (one exchange, which carries the compact record, not its items); a
running count inside each partition is written with them, and the counts of the partitions before, one row for each
partition, are added on reading. Nothing depends on how dense the keys are.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialize


def with_positions(records: DataFrame, order: str | list[str], size: Column,
                   base_col: str = "base", total_col: str = "total") -> DataFrame:
    """``records`` with ``base`` (items of all earlier records) and ``total`` (items of all records).

    ``size`` is the number of items of a record. Record order is ``order`` ascending; records equal in it are ordered
    by a hash of their other columns and then by these, so equal keys spread over partitions and only rows equal in
    everything are interchangeable. Records without a key have no place and are dropped.
    """
    order = [order] if isinstance(order, str) else list(order)
    names = records.columns
    others = [c for c in names if c not in order]
    keyed = records.dropna(subset=order).select("*", (F.xxhash64(*others) if others else F.lit(0).cast("long")).alias("_tie"))
    ranged = keyed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie", *others)

    def running(batches):
        before = 0
        for batch in batches:
            n = batch.column(len(names)).to_numpy()
            inner = n.cumsum() - n + before
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inner)], [*names, "_n", "_part", "_inner"])

    schema = T.StructType([*(records.schema[c] for c in names), T.StructField("_n", T.LongType()),
                           T.StructField("_part", T.IntegerType()), T.StructField("_inner", T.LongType())])
    # items are counted behind the exchange: before it, the sampling of the keys would count them once more
    placed = ranged.select(*names, size.cast("long").alias("_n"), F.spark_partition_id().alias("_part")).mapInArrow(running, schema)
    placed = materialize(placed, "positions")  # a second run of the sort could choose other split points
    per_part = placed.groupBy("_part").agg(F.sum("_n").alias("_items"))
    offsets = per_part.select(
        "_part",
        (F.sum("_items").over(Window.orderBy("_part")) - F.col("_items")).alias("_before"),
        F.sum("_items").over(Window.partitionBy()).alias(total_col),
    )
    # One row per partition of the sort.
    return placed.join(F.broadcast(offsets), "_part").select(
        *names, (F.col("_before") + F.col("_inner")).alias(base_col), total_col)


def window_slices(placed: DataFrame, items: Column, window_size: int) -> DataFrame:
    """One row per (record, window): ``window_id``, ``start`` (position of the first item) and ``items`` of the slice.

    ``placed`` comes from :func:`with_positions`; a record's items are cut where a window of ``window_size`` positions
    ends. Only full windows are kept (the last, partial one never fires).
    """
    n = F.lit(window_size)
    cut = placed.select("base", "total", items.alias("_items"))
    windows = F.sequence(F.expr(f"base div {window_size}"), F.expr(f"(base + size(_items) - 1) div {window_size}"))

    def piece(window: Column) -> Column:
        start = F.greatest(F.col("base"), window * n)
        end = F.least(F.col("base") + F.size("_items"), (window + 1) * n)
        own = F.slice("_items", (start - F.col("base") + 1).cast("int"), (end - start).cast("int"))
        return F.struct(window.alias("window_id"), start.alias("start"), own.alias("items"))

    # A filter on the size of the items would build them a second time; an exploded row takes its own slice along only.
    pieces = F.when(F.size("_items") > 0, F.transform(windows, piece))
    return cut.select("total", F.explode(pieces).alias("_slice")).filter(
        F.col("_slice.window_id") < F.expr(f"total div {window_size}")).select("_slice.window_id", "_slice.start", "_slice.items")
