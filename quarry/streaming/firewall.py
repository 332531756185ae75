"""The firewall log of two endless streams: trace records and verdicts joined as they arrive, and counts per source kept.

A record and a verdict of one connection meet if they arrive within ``within`` of each other. Both sides have a watermark
of ``lateness`` on their arrival, which with that range bounds the state of both: what can no longer meet anything is
dropped. Arrival is the modification time of the text file that brought the line.

The counts are a second stream over the log's files, per window of the time at which they were written. That time
never runs backwards by more than clocks differ (``CLOCKS``), so each window is closed and appended once and no row
of the log is late for it. A report adds the closed windows up and counts only the log's files after them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.relational import blocked_verdicts
from quarry.sources.text import parse_trace, parse_verdicts
from quarry.streaming.stateful_windows import append_to
from quarry.streaming.text_stream import line_stream

WITHIN, LATENESS, CLOCKS, WINDOW = "1 day", "1 hour", "10 minutes", "1 hour"
LOG = ["time", "connection_id", "source_ip", "destination_ip", "action"]


def firewall_log_stream(trace: DataFrame, verdicts: DataFrame, case_sensitive: bool = False, within: str = WITHIN, lateness: str = LATENESS) -> DataFrame:
    """Streaming inner join of records and blocking verdicts, each with a column ``arrived``; ``arrived`` of a log row is the later one.

    Rows as in ``relational.firewall_log``: NULL ids never match, repeated ones multiply.
    """
    records = trace.withWatermark("arrived", lateness).alias("t")
    blocked = blocked_verdicts(verdicts, case_sensitive).withWatermark("arrived", lateness).alias("v")
    range_ = F.expr(f"v.arrived between t.arrived - interval {within} and t.arrived + interval {within}")
    joined = records.join(blocked, (F.col("t.connection_id") == F.col("v.connection_id")) & range_)
    return joined.select("t.time", "t.connection_id", "t.source_ip", "t.destination_ip", "v.action", F.greatest("t.arrived", "v.arrived").alias("arrived"))


def text_streams(spark: SparkSession, trace_path: str, verdict_path: str, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Trace records and verdicts of two folders of text files, with ``arrived``."""
    trace, verdicts = (line_stream(spark, path, max_files).select(F.col("modified").alias("arrived"), "value") for path in (trace_path, verdict_path))
    return parse_trace(trace, keep=["arrived"]), parse_verdicts(verdicts, keep=["arrived"])


def source_counts_stream(spark: SparkSession, log_path: str, schema, window: str = WINDOW) -> DataFrame:
    """Streaming ``(closed_at, source_ip, n)`` of the log's files, a row for each source in each closed window."""
    log = spark.readStream.schema(schema).parquet(log_path).select("source_ip", F.col("_metadata.file_modification_time").alias("written"))
    counts = log.withWatermark("written", CLOCKS).groupBy(F.window("written", window).alias("w"), "source_ip").agg(F.count("source_ip").alias("n"))
    return counts.select(F.col("w.end").alias("closed_at"), "source_ip", "n")


def advance(spark: SparkSession, trace_path: str, verdict_path: str, folder: str, max_files: int | None = None, window: str = WINDOW, **options) -> tuple[DataFrame, DataFrame]:
    """Join and count what has come since the last run with this ``folder``: the log so far and ``(source_ip, num_blocks)`` so far."""
    stream = firewall_log_stream(*text_streams(spark, trace_path, verdict_path, max_files), **options)
    log = append_to(stream, f"{folder}/log", f"{folder}/log-state")
    closed = append_to(source_counts_stream(spark, f"{folder}/log", stream.schema, window), f"{folder}/counts", f"{folder}/counts-state")
    upto = closed.agg(F.max("closed_at")).first()[0]
    rest = log.select("source_ip", F.col("_metadata.file_modification_time").alias("written"))
    rest = rest if upto is None else rest.filter(F.col("written") >= F.lit(upto))
    rest = rest.groupBy("source_ip").agg(F.count("source_ip").alias("n"))
    counts = closed.select("source_ip", "n").unionAll(rest).groupBy("source_ip").agg(F.sum("n").alias("num_blocks"))
    return log.select(*LOG), counts
