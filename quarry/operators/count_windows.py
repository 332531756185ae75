"""Tumbling count windows (every N consecutive items) with a top-k report per window, in batch.

Item positions come from ``ordinals.with_positions``. Each record's items are cut into slices that lie in one window;
words are counted per slice before the shuffle, and for bigrams a slice travels as one row, so no row is one token.
Windows hold exactly N items, so grouping by window is skew-free by construction.
"""

from __future__ import annotations

from collections import Counter
from heapq import nlargest, nsmallest

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import SENTENCE_MARK, kept_tokens
from quarry.operators.ordinals import window_slices, with_positions
from quarry.operators.topk import top_k_per_group

WINDOW_SIZE = 1000
TOP_K = 10


def word_window_topk(records: DataFrame, order: str | list[str], words: Column, n_words: Column | None = None,
                     window_size: int = WINDOW_SIZE, k: int = TOP_K) -> DataFrame:
    """Top ``k`` words of every full window of ``window_size`` words: ``(window_id, rank, word, n)``.

    ``records`` hold an order key and what ``words`` (an array expression) is computed from; ``n_words`` is its size, if
    that is cheaper to say. Ties by word ascending.
    """
    placed = with_positions(records, order, F.size(words) if n_words is None else n_words)
    slices = window_slices(placed, words, window_size)
    counts = (slices.select("window_id", F.explode("items").alias("word"))
              .groupBy("window_id", "word").agg(F.count(F.lit(1)).alias("n")))
    ranked = top_k_per_group(counts, ["window_id"], [F.col("n").desc(), F.col("word").asc()], k)
    return ranked.select("window_id", "rank", "word", "n")


def kept_slices(slices: DataFrame, lowercase: bool = True) -> DataFrame:
    """``(window_id, start, kept)``: the kept tokens of each slice of raw tokens as one string, blanks between them.

    A stripped word holds letters and digits only, so neither a blank nor a mark can be part of one.
    """
    return slices.select("window_id", "start", F.array_join(kept_tokens("items", lowercase), " ").alias("kept"))


def window_pair_topk(kept: DataFrame, k: int) -> DataFrame:
    """``(window_id, rank, w1, w2, n)``: the ``k`` most frequent bigrams of each window from :func:`kept_slices`.

    A word pairs with the previous kept token of the same window if that was a word; pairs cross record boundaries but
    never window boundaries. The one exchange deals the windows, which hold at most N tokens each, and carries the text;
    a task reads its windows one after the other and counts the pairs of one at a time.
    """
    dealt = kept.repartition("window_id").sortWithinPartitions("window_id", "start")
    mark = SENTENCE_MARK

    def best(texts: list[str]) -> list[tuple]:
        pairs = Counter()
        for run in " ".join(texts).split(mark):
            words = run.split()
            pairs.update(zip(words, words[1:]))
        counts = nlargest(k, pairs.values())
        least = counts[-1] if counts else 0
        return nsmallest(k, [(-n, w1, w2) for (w1, w2), n in pairs.items() if n >= least])

    def report(batches):
        def out(rows: list[tuple]) -> pa.RecordBatch:
            windows, ranks, counts, firsts, seconds = zip(*rows)
            columns = [pa.array(windows, pa.int64()), pa.array(ranks, pa.int64()), pa.array(firsts, pa.string()),
                       pa.array(seconds, pa.string()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["window_id", "rank", "w1", "w2", "n"])

        def ranked() -> list[tuple]:
            return [(here, rank, -n, w1, w2) for rank, (n, w1, w2) in enumerate(best(texts), 1)]

        here, texts = None, []
        for batch in batches:
            rows, ids = [], batch.column(0).to_pylist()
            edges = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)] if ids else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if ids[lo] != here:
                    rows += ranked()
                    here, texts = ids[lo], []
                texts += batch.column(2).slice(lo, hi - lo).to_pylist()
            if rows:
                yield out(rows)
        rows = ranked()
        if rows:
            yield out(rows)

    return dealt.mapInArrow(report, "window_id long, rank long, w1 string, w2 string, n long")


def bigram_window_topk(records: DataFrame, order: str | list[str], tokens: Column, n_tokens: Column | None = None,
                       window_size: int = WINDOW_SIZE, k: int = TOP_K, lowercase: bool = True) -> DataFrame:
    """Top ``k`` bigrams of every full window of ``window_size`` raw tokens: ``(window_id, rank, w1, w2, n)``.

    Arguments as for :func:`word_window_topk`; ties by (w1, w2). ``lowercase=False`` for text that is lower-case already.
    """
    placed = with_positions(records, order, F.size(tokens) if n_tokens is None else n_tokens)
    return window_pair_topk(kept_slices(window_slices(placed, tokens, window_size), lowercase), k)
