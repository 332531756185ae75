"""Text files as an endless stream of items with dense positions, in the order in which the files come.

Three streams with checkpoints of their own, each run over what has come since its last run (``availableNow``):

1. ``ingest``: lines into a table, each with the number of items before it in its split of the file; the last row of a split
   holds the split's total. A split is read by one task, in order, so this needs no state and no shuffle.
2. ``place``: one state for the stream holds the number of items so far; a micro-batch hands it one row per split, in the
   order (modification time, path, split start), and gets the splits' offsets. No line passes through it.
3. ``placed_lines``: the table's lines as a stream, joined with the offsets, which are complete when the second has run; a line
   without one fails the job and is never dropped. Any stateful operator can follow.

Files must not change once they are seen. A file counts when it is ingested: one that comes later stands behind those
of earlier runs, however old it is. Stopping between or within the three loses and repeats nothing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from quarry.streaming.stateful_windows import append_to

SPLIT = ["file", "modified", "split"]
LINES = "file string, modified timestamp, split long, value string, n long, before long, total long"
OFFSETS = "file string, modified timestamp, split long, offset long"


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``(file, modified, split, value)`` of every line of the text files of a folder, as they come."""
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_block_start").alias("split")]
    return reader.text(path).select(*place, "value")


def counted(lines: DataFrame, size: Column) -> DataFrame:
    """The lines with ``n`` items each, ``before`` of them in the split, and one row per split with its ``total`` only."""

    def running(batches):
        here, before = None, 0

        def end() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": here[0], "modified": here[1], "split": here[2], "total": before}], schema=form)

        form = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if form is None:
                fields = [table.schema.field(k) for k in range(4)]
                form = pa.schema([*fields, *(pa.field(name, pa.int64()) for name in ("n", "before", "total"))])
            keys = list(zip(*(table.column(k).to_pylist() for k in range(3))))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if lo == hi:
                    continue
                if keys[lo] != here:
                    if here is not None:
                        yield end()
                    here, before = keys[lo], 0
                n = batch.column(4).slice(lo, hi - lo).to_numpy()
                inner = n.cumsum() - n + before
                before += int(n.sum())
                columns = [batch.column(k).slice(lo, hi - lo) for k in range(5)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(inner, pa.int64()), pa.nulls(hi - lo, pa.int64())], schema=form)
        if here is not None:
            yield end()

    return lines.select(*SPLIT, "value", size.cast("long").alias("n")).mapInArrow(running, LINES)


def ingest(spark: SparkSession, path: str, folder: str, size: Column, max_files: int | None = None) -> None:
    """Append the new files' lines to the table under ``folder``; ``size`` is the number of items of a line ``value``."""
    append_to(counted(line_stream(spark, path, max_files), size), f"{folder}/lines", f"{folder}/lines-state")


def _lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    return reader.schema(LINES).parquet(f"{folder}/lines")


def place(spark: SparkSession, folder: str) -> None:
    """Give the new splits their offsets."""

    def step(key, batches, state):
        import pandas as pd

        before = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(["modified", "file", "split"])  # one row per split
        rows["offset"] = before + rows["total"].cumsum() - rows["total"]
        state.update((int(before + rows["total"].sum()),))
        yield rows[["file", "modified", "split", "offset"]]

    totals = _lines(spark, folder).filter("total is not null").select(*SPLIT, "total", F.lit(0).alias("stream"))
    offsets = totals.groupBy("stream").applyInPandasWithState(step, OFFSETS, "before long", "append", GroupStateTimeout.NoTimeout)
    append_to(offsets, f"{folder}/offsets", f"{folder}/offsets-state")


def placed_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of ``(position, value, modified)``: every line with the position of its first item. A micro-batch takes
    ``max_files`` files of the table, so that what a stateful task gets of it doesn't grow with what has come."""
    offsets = spark.read.schema(OFFSETS).parquet(f"{folder}/offsets").select("file", "split", "offset")
    lines = _lines(spark, folder, max_files).filter("total is null").join(offsets, ["file", "split"], "left")
    missing = F.raise_error(F.concat(F.lit("no offset yet: "), "file")).cast("long")
    return lines.select(F.coalesce(F.col("offset"), missing).alias("at"), "before", "value", "modified").select((F.col("at") + F.col("before")).alias("position"), "value", "modified")


def advance(spark: SparkSession, path: str, folder: str, size: Column, windows, max_files: int | None = None) -> DataFrame:
    """Run all three over what has come, then ``windows(placed_lines)`` appended to ``folder``; all its rows so far."""
    ingest(spark, path, folder, size, max_files)
    place(spark, folder)
    return append_to(windows(placed_lines(spark, folder, max_files)), f"{folder}/out", f"{folder}/out-state")
