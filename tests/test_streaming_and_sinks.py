"""Batch and streaming count windows agree; sinks write the documented text forms."""

import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.operators import count_windows
from quarry.plans import inputs
from quarry.sinks import writers

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_registered_stream_has_full_windows_only(spark):
    df = entry.queries()["stream_word_window_topk"](spark, SF)
    assert sorted({r.window_id for r in df.collect()}) == [0]  # 1000 events: one full window


def test_tuple_and_tab_text(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "b", 2.5)], "n int, w string, x double")
    base = tempfile.mkdtemp(prefix="quarry-sink-", dir="/tmp")
    writers.write_tuple_text(df, os.path.join(base, "tuples"), num_files=1, order=["n"])
    got = [r.value for r in spark.read.text(os.path.join(base, "tuples")).collect()]
    assert got == ["(1,b,2.5)", "(3,a,null)"]
    writers.write_tab_text(df, os.path.join(base, "tsv"), num_files=2, order=["n"])
    got = sorted(r.value for r in spark.read.text(os.path.join(base, "tsv")).collect())
    assert got == ["1\tb\t2.5", "3\ta\t"]


def test_stateful_stream_windows_equal_batch(spark):
    from quarry.streaming import stateful_windows as sw

    events = inputs.table(spark, SF, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events*.parquet").parquet(SF)
    words = stream.select(F.col("event_id").alias("ordinal"), F.expr(inputs.STREAM_WORD_SQL).alias("word"))
    got = sw.run_to_files(sw.word_window_topk_stateful(words, window_size=100, k=10), spark, "t_sw")
    records = events.select("event_id", F.array(F.expr(inputs.STREAM_WORD_SQL)).alias("w"))
    assert _rows(got) == _rows(count_windows.word_window_topk(records, "event_id", F.col("w"), None, 100, 10))

    toks = stream.select(F.col("event_id").alias("ordinal"), F.expr(inputs.STREAM_TOKEN_SQL).alias("token"))
    got = sw.run_to_files(sw.bigram_window_topk_stateful(toks, window_size=100, k=10), spark, "t_sb")
    records = events.select("event_id", F.array(F.expr(inputs.STREAM_TOKEN_SQL)).alias("t"))
    assert _rows(got) == _rows(count_windows.bigram_window_topk(records, "event_id", F.col("t"), None, 100, 10))


def test_stateful_windows_over_replays_gaps_nulls_and_late_data(spark, tmp_path):
    """Five micro-batches: a window is reported once, when its last position has come, and never from repeats."""
    from quarry.streaming import stateful_windows as sw

    batches = [
        [(p, f"w{p % 3}") for p in range(7)] + [(None, "x")] * 20,  # window 0 begins; no position, no window
        [(p, f"w{p % 3}") for p in range(7, 10)] + [(p, "a") for p in range(10, 19)] + [(13, "b")] * 3,  # 0 complete; 19 is missing
        [(p, "again") for p in range(10)],  # a replay of window 0
        [(p, "c") for p in range(20, 30)],  # window 2 before window 1
        [(19, "late")],
    ]
    folder = tmp_path / "in"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "ordinal long, word string").coalesce(1).write.mode("append").parquet(str(folder))
    import glob
    import os

    for k, f in enumerate(sorted(glob.glob(f"{folder}/part-*"), key=os.path.getmtime)):
        os.utime(f, (1_000_000 + 60 * k, 1_000_000 + 60 * k))
    stream = spark.readStream.schema("ordinal long, word string").option("maxFilesPerTrigger", 1).parquet(str(folder))
    got = sw.run_to_files(sw.word_window_topk_stateful(stream, window_size=10, k=2), spark, "t_replay")
    assert sorted((r.window_id, r.rank, r.word, r.n) for r in got.collect()) == [(0, 1, "w0", 4), (0, 2, "w1", 3), (1, 1, "a", 9), (1, 2, "late", 1), (2, 1, "c", 10)]
