"""Exact top k without shuffling every distinct item: mergeable Misra-Gries summaries, then a recount of the candidates.

Each task keeps at most ``capacity`` counters. When it has more, the size of the next largest is taken off all and those
that reach zero go; the sum of what was taken is the most by which any count of the task is too low (Agarwal et al.,
Mergeable Summaries, 2012). Summaries are added up, and so is what they may lack, ``lacking``. If the k-th largest sum is
above ``lacking``, no item outside the summaries can be among the top k, and only items whose sum is at most
``lacking`` below the k-th are counted again exactly. If it is not (flat counts), or there are more than ``MOST_CANDIDATES``,
everything is counted as usual: the result is the same, only the shuffle is larger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.topk import top_k
from quarry.session import materialize

CAPACITY = 20_000
#: Candidates that are counted again; they are broadcast.
MOST_CANDIDATES = 100_000
#: Items that a task gathers before it merges them into its summary.
GATHER = 500_000


def summaries(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(item columns, n, lacking)``: at most ``capacity`` counters a task, and one row with its ``lacking`` only."""
    keys = items.columns
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in items.schema), T.StructField("n", T.LongType()), T.StructField("lacking", T.LongType())])

    def summarise(batches):
        counters, waiting, rows, lacking, form = None, [], 0, 0, None

        def merged() -> None:
            nonlocal counters, rows, lacking
            new = pa.Table.from_batches(waiting).group_by(keys).aggregate([([], "count_all")]).rename_columns([*keys, "n"])
            if counters is not None:
                new = pa.concat_tables([counters, new]).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])
            if len(new) > capacity:
                n = new["n"].to_numpy()
                off = int(np.partition(n, len(n) - capacity - 1)[len(n) - capacity - 1])
                lacking += off
                new = new.set_column(len(keys), "n", pa.array(n - off)).filter(pa.array(n > off))
            counters, rows = new, 0
            waiting.clear()

        for batch in batches:
            form = batch.schema
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= GATHER:
                merged()
        if waiting:
            merged()
        if counters is not None:
            for part in counters.to_batches(max_chunksize=10_000):
                yield pa.RecordBatch.from_arrays([*(pc.cast(part[k], form.field(k).type) for k in keys), part["n"], pa.nulls(len(part), pa.int64())], [*keys, "n", "lacking"])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, form.field(k).type) for k in keys), pa.nulls(1, pa.int64()), pa.array([lacking], pa.int64())], [*keys, "n", "lacking"])

    return items.mapInArrow(summarise, schema)


def top_k_items(items: DataFrame, order: list[Column], k: int = 10, capacity: int = CAPACITY, out: str = "n") -> DataFrame:
    """The ``k`` most frequent rows of ``items`` with their counts ``out`` and ``rank``; ``order`` begins with the count, falling.

    ``items`` is read twice, so it should come from files. Equal to a full count at any capacity.
    """
    keys = items.columns
    parts = materialize(summaries(items, capacity), "summaries")
    lacking = parts.agg(F.sum("lacking")).first()[0] or 0
    sums = materialize(parts.filter("n is not null").groupBy(*keys).agg(F.sum("n").alias("n")), "summary")
    if lacking == 0:
        return top_k(sums.withColumnRenamed("n", out), order, k)
    kth, found = sums.orderBy(F.col("n").desc()).limit(k).agg(F.min("n"), F.count("*")).first()
    if found == k and kth > lacking:
        candidates = sums.filter(F.col("n") >= kth - lacking).select(keys)
        if candidates.count() <= MOST_CANDIDATES:
            same = [items[c].eqNullSafe(candidates[c]) for c in keys]
            items = items.join(F.broadcast(candidates), same, "left_semi")
    return top_k(items.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)), order, k)
