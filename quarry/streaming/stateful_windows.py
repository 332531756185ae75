"""Count windows on an endless stream: state per shard of windows, each window reported once.

Records carry their stream position (a dense id, a log offset, or the one ``text_stream`` assigns); a window is
``position div N``, and window w belongs to shard ``w mod shards``. ``groupBy(shard).applyInPandasWithState`` keeps the
positions seen and the items of the shard's open windows, and the windows that have been reported as intervals, so that a
replay cannot reopen one. Windows that close one after the other make one interval: state is bounded by the open windows,
the gaps between closed ones and the number of shards, not by the length of the stream. A window is complete when all
its N positions have been seen: a position that comes again is ignored, a NULL position belongs to no window. Without
an event time a gap leaves its window open; with one, a window to which nothing was added while the watermark
passed ``gap_ms`` is reported with ``complete = false`` and closed, and what is late by the watermark is ignored.

A micro-batch's rows of one shard pass one Python call, so a source limits its batches (``maxFilesPerTrigger``) to what the
shards can hold. The output is append-only (any file or table sink). Text semantics (tokenising, word / sentence-end
classification) stay in JVM expressions before this step; the Python side only counts and ranks, with the same tie
rules as the batch operators (frequency descending, then item ascending).
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from quarry.functions.numbers import floor_div
from quarry.functions.text import SENTENCE_MARK, classify_token
from quarry.session import scratch_path

WINDOW_SIZE = 1000
TOP_K = 10
SHARDS = 64

WORD_OUT = "window_id long, rank long, word string, n long"
BIGRAM_OUT = "window_id long, rank long, w1 string, w2 string, n long"
STATE = "closed_from array<long>, closed_to array<long>, windows array<long>, times array<long>, positions array<long>, items array<string>"


def window_step(window_size: int, shards: int, report: Callable[[int, list], pd.DataFrame], gap_ms: int | None = None):
    """The state function of one shard: rows (window_id, start, items[, event_ms]) in, reports out.

    It ships to Python workers by value: it may use only the standard library, pandas and its closure.
    """

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        low, high, windows, times, positions, items = map(list, state.get) if state.exists else ([], [], [], [], [], [])
        opened: dict[int, dict] = {w: {} for w in windows}
        last = dict(zip(windows, times))
        for p, item in zip(positions, items):
            opened[p // window_size][p] = item

        def closed(window: int) -> bool:
            at = bisect_right(low, window // shards) - 1
            return at >= 0 and window // shards <= high[at]

        def close(window: int) -> list:
            nth = window // shards  # place among the windows of the shard
            at = bisect_right(low, nth)
            joins_left, joins_right = at > 0 and high[at - 1] == nth - 1, at < len(low) and low[at] == nth + 1
            if joins_left and joins_right:
                high[at - 1] = high[at]
                del low[at], high[at]
            elif joins_left:
                high[at - 1] = nth
            elif joins_right:
                low[at] = nth
            else:
                low.insert(at, nth)
                high.insert(at, nth)
            seen = opened.pop(window)
            last.pop(window)
            return [seen[p] for p in sorted(seen)]

        def reported(window: int, complete: bool) -> pd.DataFrame:
            out = report(window, close(window))
            return out.assign(complete=complete) if gap_ms is not None else out

        for pdf in batches:
            moments = pdf["event_ms"].tolist() if gap_ms is not None else [0] * len(pdf)
            for window, start, own, moment in zip(pdf["window_id"].tolist(), pdf["start"].tolist(), pdf["items"], moments):
                if closed(window):
                    continue
                seen = opened.setdefault(window, {})
                before = len(seen)
                for p, item in enumerate(own, start):
                    seen.setdefault(p, item)
                if len(seen) > before or window not in last:
                    last[window] = max(moment, last.get(window, moment))
                if len(seen) == window_size:
                    yield reported(window, True)
        if gap_ms is not None:
            watermark = state.getCurrentWatermarkMs()
            for window in sorted(w for w, t in last.items() if t + gap_ms <= watermark):
                yield reported(window, False)
        order = sorted(opened)
        state.update((low, high, order, [last[w] for w in order], [p for w in order for p in opened[w]], [x for w in order for x in opened[w].values()]))
        if gap_ms is not None and opened:
            state.setTimeoutTimestamp(max(min(last.values()) + gap_ms, watermark + 1))

    return step


def _windowed(records: DataFrame, position: str, items: Column, window_size: int, schema: str, report: Callable[[int, list], pd.DataFrame],
              shards: int, event_time: str | None, gap_ms: int | None) -> DataFrame:
    """``records`` hold the position of the first of ``items``; ``report(window_id, items in order)`` once a window is closed."""
    if (event_time is None) != (gap_ms is None):
        raise ValueError("event_time and gap_ms go together")
    first, n = F.col(position).cast("long"), window_size
    rows = records.filter(F.col(position).isNotNull()).select(first.alias("base"), items.alias("items"), *([F.col(event_time).alias("event_time")] if event_time else []))
    last = floor_div(F.col("base") + F.size("items") - 1, n)
    windows = F.explode(F.when(F.size("items") > 0, F.sequence(floor_div(F.col("base"), n), last)).otherwise(F.array().cast("array<long>")))
    cut = rows.select("*", windows.alias("window_id")).withColumn("start", F.greatest(F.col("base"), F.col("window_id") * n))
    end = F.least(F.col("base") + F.size("items"), (F.col("window_id") + 1) * n)
    own = F.slice("items", (F.col("start") - F.col("base") + 1).cast("int"), (end - F.col("start")).cast("int"))
    cut = cut.select(F.pmod("window_id", F.lit(shards)).alias("shard"), "window_id", "start", own.alias("items"), *([F.col("event_time"), F.unix_millis("event_time").alias("event_ms")] if event_time else []))
    timeout = GroupStateTimeout.EventTimeTimeout if event_time else GroupStateTimeout.NoTimeout
    schema = f"{schema}, complete boolean" if event_time else schema
    return cut.groupBy("shard").applyInPandasWithState(window_step(window_size, shards, report, gap_ms), schema, STATE, "append", timeout)


def word_report(k: int = TOP_K) -> Callable[[int, list], pd.DataFrame]:
    """Top ``k`` words of a window; a NULL word fills its position only."""

    def report(window_id: int, words: list) -> pd.DataFrame:
        counts = Counter(w for w in words if w is not None)
        top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        return pd.DataFrame({"window_id": [window_id] * len(top), "rank": range(1, len(top) + 1),
                             "word": [w for w, _ in top], "n": [n for _, n in top]})

    return report


def bigram_report(k: int = TOP_K) -> Callable[[int, list], pd.DataFrame]:
    """Top ``k`` bigrams of a window's classified tokens: only words and sentence ends are kept, and paired in order."""
    mark = SENTENCE_MARK

    def report(window_id: int, tokens: list) -> pd.DataFrame:
        kept = [t for t in tokens if t is not None]
        pairs = Counter((a, b) for a, b in zip(kept, kept[1:]) if a != mark and b != mark)
        top = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        return pd.DataFrame({"window_id": [window_id] * len(top), "rank": range(1, len(top) + 1),
                             "w1": [p[0] for p, _ in top], "w2": [p[1] for p, _ in top],
                             "n": [n for _, n in top]})

    return report


def word_window_topk_stateful(items: DataFrame, ordinal: str = "ordinal", word: str | Column = "word", window_size: int = WINDOW_SIZE,
                              k: int = TOP_K, shards: int = SHARDS, event_time: str | None = None, gap_ms: int | None = None) -> DataFrame:
    """Streaming ``(window_id, rank, word, n)``, appended once per closed window. ``word`` is a column, or an expression for
    the array of the words from position ``ordinal`` on."""
    words = F.array(F.col(word)) if isinstance(word, str) else word
    return _windowed(items, ordinal, words, window_size, WORD_OUT, word_report(k), shards, event_time, gap_ms)


def bigram_window_topk_stateful(items: DataFrame, ordinal: str = "ordinal", token: str | Column = "token", window_size: int = WINDOW_SIZE,
                                k: int = TOP_K, shards: int = SHARDS, event_time: str | None = None, gap_ms: int | None = None) -> DataFrame:
    """Streaming ``(window_id, rank, w1, w2, n)``, appended once per closed window.

    Every raw token fills its position; ``token`` is a column, or an expression for the array of the tokens from position
    ``ordinal`` on.
    """
    tokens = F.array(classify_token(token)) if isinstance(token, str) else F.transform(token, lambda t: classify_token(t))
    return _windowed(items, ordinal, tokens, window_size, BIGRAM_OUT, bigram_report(k), shards, event_time, gap_ms)


def run_to_files(stream: DataFrame, spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """Append a stream into files under the checkpoint directory (``availableNow``); read them back."""
    return append_to(stream, scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state"), fmt)


def append_to(stream: DataFrame, out: str, state: str, fmt: str = "parquet") -> DataFrame:
    """Append what has come since the last run with this ``state`` folder to the files in ``out``; read all of them."""
    q = stream.writeStream.outputMode("append").format(fmt).option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return stream.sparkSession.read.schema(stream.schema).format(fmt).load(out)
