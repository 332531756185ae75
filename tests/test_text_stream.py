"""Streams of text files: positions carried over micro-batches and restarts, windows retired, gaps reported."""

import os
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions.text import lower_word_count, lower_word_tokens, space_token_count, space_tokens
from quarry.operators import count_windows
from quarry.streaming import stateful_windows as sw
from quarry.streaming import text_stream

R = random.Random(11)


def _write(folder, k, lines, when):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/log-{k:03}.txt"
    with open(path, "w", newline="") as f:
        f.write("".join(f"{x}\n" for x in lines))
    os.utime(path, (when, when))


def _lines(n):
    return [" ".join(R.choice(["a", "B", "c.", "d!", "", "e,", "42", "É"]) for _ in range(R.randint(0, 12))) for _ in range(n)]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("kind", ["words", "bigrams"])
def test_text_stream_equals_batch_over_restarts(spark, tmp_path, kind):
    files, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    all_lines = []
    if kind == "words":
        size, batch, n_batch, items = lower_word_count("value"), count_windows.word_window_topk, lower_word_count("value"), lower_word_tokens("value")
        windows = lambda lines: sw.word_window_topk_stateful(lines, "position", lower_word_tokens("value"), 20, 3, shards=4)
    else:
        size, batch, n_batch, items = space_token_count("value"), count_windows.bigram_window_topk, space_token_count("value"), space_tokens("value")
        windows = lambda lines: sw.bigram_window_topk_stateful(lines, "position", space_tokens("value"), 20, 3, shards=4)
    per_run = [[30, 0, 7], [1], [25, 40]]
    k = 0
    for sizes in per_run:
        for n in sizes:
            own = _lines(n)
            # the first file of a run is older than the last of the run before: it still comes after it
            _write(files, k, own, 1_000_000 + 60 * k)
            all_lines += own
            k += 1
        got = text_stream.advance(spark, files, folder, size, windows, max_files=1)
        records = spark.createDataFrame(list(enumerate(all_lines)), "i long, value string")
        assert _rows(got) == _rows(batch(records, "i", items, n_batch, 20, 3))
    assert got.count() > 0


def test_stopping_between_the_steps_loses_nothing(spark, tmp_path):
    files, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    size = space_token_count("value")
    windows = lambda lines: sw.word_window_topk_stateful(lines, "position", space_tokens("value"), 4, 2, shards=2)
    _write(files, 0, ["a b c", "d"], 1_000_000)
    text_stream.ingest(spark, files, folder, size)  # stopped here
    _write(files, 1, ["e f", "g h i"], 1_000_060)
    text_stream.ingest(spark, files, folder, size)
    text_stream.place(spark, folder)  # and here
    got = text_stream.advance(spark, files, folder, size, windows)
    assert {(r.window_id, r.word) for r in got.collect()} == {(0, "a"), (0, "b"), (1, "e"), (1, "f")}


def test_lines_without_an_offset_fail(spark, tmp_path):
    files, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    _write(files, 0, ["a"], 1_000_000)
    text_stream.ingest(spark, files, folder, space_token_count("value"))
    text_stream.place(spark, folder)
    _write(files, 1, ["b"], 1_000_060)
    text_stream.ingest(spark, files, folder, space_token_count("value"))
    with pytest.raises(Exception, match="no offset yet"):
        sw.run_to_files(text_stream.placed_lines(spark, folder), spark, "t_missing")


class _State:
    def __init__(self):
        self.exists, self.value, self.timeout, self.watermark = False, None, None, 0

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.exists, self.value = True, value

    def setTimeoutTimestamp(self, at):
        assert at > self.watermark
        self.timeout = at

    def getCurrentWatermarkMs(self):
        return self.watermark


def _frame(rows):
    return pd.DataFrame([(w, s, items, t) for w, s, items, t in rows], columns=["window_id", "start", "items", "event_ms"])


def test_state_stays_flat_over_ten_thousand_windows_with_replays():
    shards, state = 4, _State()
    step = sw.window_step(2, shards, sw.word_report(1))
    reports, most = Counter(), 0
    ids = [w * shards + 3 for w in range(10_000)]
    for k in range(0, len(ids), 100):
        new = ids[k : k + 100]
        R.shuffle(new)
        replay = R.sample(ids[:k], min(k, 50))
        rows = [(w, 2 * w + p, ["x"], 0) for w in [*new, *replay] for p in (1, 0)]
        for out in step((3,), iter([_frame(rows)]), state):
            reports.update(out["window_id"])
        most = max(most, sum(map(len, state.value)))
    assert reports == Counter(ids)
    assert most == 2 and state.value[:2] == ([0], [9_999])


def test_closed_windows_merge_in_any_order():
    order = list(range(50))
    R.shuffle(order)
    state, step = _State(), sw.window_step(1, 1, sw.word_report(1))
    for k, w in enumerate(order):
        list(step((0,), iter([_frame([(w, w, ["x"], 0)])]), state))
        low, high = state.value[:2]
        assert [x for a, b in zip(low, high) for x in range(a, b + 1)] == sorted(order[: k + 1])
        assert all(b + 1 < a for b, a in zip(high, low[1:]))


def test_a_gap_is_reported_as_incomplete_once_the_watermark_has_passed():
    state, step = _State(), sw.window_step(3, 1, sw.word_report(2), gap_ms=100)
    assert list(step((0,), iter([_frame([(0, 0, ["a", "b"], 1000), (1, 3, ["c", "d", "e"], 1000)])]), state))[0]["complete"].tolist() == [True, True]
    assert state.timeout == 1100
    state.watermark = 1099
    assert list(step((0,), iter([]), state)) == []
    state.watermark = 1100
    (out,) = step((0,), iter([]), state)
    assert out[["window_id", "word", "complete"]].values.tolist() == [[0, "a", False], [0, "b", False]]
    assert list(step((0,), iter([_frame([(0, 2, ["late"], 1200)])]), state)) == []  # closed
    assert state.value == ([0], [1], [], [], [], [])


def test_a_stream_with_event_times_reports_its_gap(spark, tmp_path):
    folder = str(tmp_path / "in")
    batches = [[(0, "a", 100), (1, "b", 101), (5, "x", 102)], [(6, "y", 500), (7, "z", 501)], [(2, "late", 90), (8, "w", 502)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "ordinal long, word string, s long").select("ordinal", "word", F.timestamp_seconds("s").alias("at")).coalesce(1).write.parquet(f"{folder}/{k}")
        for name in os.listdir(f"{folder}/{k}"):
            os.utime(f"{folder}/{k}/{name}", (1_000_000 + 60 * k,) * 2)
    stream = spark.readStream.schema("ordinal long, word string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*").withWatermark("at", "10 seconds")
    got = sw.run_to_files(sw.word_window_topk_stateful(stream, window_size=3, k=5, shards=2, event_time="at", gap_ms=60_000), spark, "t_gap")
    assert sorted((r.window_id, r.word, r.complete) for r in got.collect()) == [(0, "a", False), (0, "b", False), (1, "x", False), (2, "w", True), (2, "y", True), (2, "z", True)]


def test_event_time_and_gap_go_together(spark):
    with pytest.raises(ValueError):
        sw.word_window_topk_stateful(spark.createDataFrame([], "ordinal long, word string"), gap_ms=5)
