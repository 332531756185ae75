"""Word and bigram counting over line DataFrames.

Counting is ``explode`` + ``groupBy().count()``: Spark aggregates partially inside every map
task (a combiner), so a hot word costs one row per task in the shuffle, not one per occurrence. The combiner of
bigrams, of which there are many more, is one with a bound.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import SENTENCE_MARK, kept_tokens, pairs_of_kept, tokenizer_tokens, whitespace_words
from quarry.operators.heavy_hitters import CAPACITY, top_k_items
from quarry.operators.topk import top_k


def words_of_lines(lines: DataFrame, line_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """One row per ``split("\\\\s+")`` word (an empty string for blank or indented lines)."""
    words = lines.select(F.explode(whitespace_words(line_col)).alias("word"))
    return words.filter(F.col("word") != "") if drop_empty else words


def word_count(lines: DataFrame, line_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """``(word, n)`` for every distinct word."""
    return words_of_lines(lines, line_col, drop_empty).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_sorted(lines: DataFrame, line_col: str = "value", drop_empty: bool = False,
                      num_partitions: int | None = None) -> DataFrame:
    """Word counts in descending count order (ties by word): a distributed range sort."""
    counts = word_count(lines, line_col, drop_empty)
    order = [F.col("n").desc(), F.col("word").asc()]
    if num_partitions:
        return counts.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    return counts.orderBy(*order)


def bigrams_of_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row ``(w1, w2)`` per bigram; bigrams never cross a line."""
    kept = lines.select(kept_tokens(tokenizer_tokens(line_col), lowercase=False).alias("_kept"))
    return kept.select(F.explode(pairs_of_kept("_kept")).alias("p")).select("p.w1", "p.w2")


#: Different bigrams that a task counts before it sends them on.
HELD_PAIRS = 250_000


def partial_bigram_counts(lines: DataFrame, line_col: str = "value", held: int = HELD_PAIRS) -> DataFrame:
    """``(w1, w2, n)`` of stretches of lines with about ``held`` different bigrams each.

    Spark's own partial aggregation keeps every bigram of a task's lines, most of which are rare; here a task's memory
    doesn't depend on how much it reads, and a frequent bigram still costs one row a stretch.
    """
    kept = lines.select(F.array_join(kept_tokens(tokenizer_tokens(line_col), lowercase=False), " ").alias("kept"))
    mark = SENTENCE_MARK

    def count(batches):
        pairs = Counter()

        def out() -> pa.RecordBatch:
            first, second = zip(*pairs)
            columns = [pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(pairs.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["w1", "w2", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for line in batch.column(0).slice(lo, 256).to_pylist():
                    for run in (line or "").split(mark):
                        words = run.split()
                        pairs.update(zip(words, words[1:]))
                    if len(pairs) >= held:
                        yield out()
                        pairs = Counter()
        if pairs:
            yield out()

    return kept.mapInArrow(count, "w1 string, w2 string, n long")


def bigram_count(lines: DataFrame, line_col: str = "value", num_partitions: int | None = None) -> DataFrame:
    """``(w1, w2, n)`` for every distinct bigram, bigrams formed inside a line. ``num_partitions``: of the shuffle."""
    by = ["w1", "w2"] if num_partitions is None else [num_partitions, "w1", "w2"]
    return partial_bigram_counts(lines, line_col).repartition(*by).groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def bigram_order() -> list[Column]:
    return [F.col("n").desc(), F.col("w1").asc(), F.col("w2").asc()]


def bigram_topk(lines: DataFrame, k: int = 10, line_col: str = "value", num_partitions: int | None = None) -> DataFrame:
    """The ``k`` most frequent bigrams, ``rank`` 1 = most frequent, ties by (w1, w2)."""
    return top_k(bigram_count(lines, line_col, num_partitions), bigram_order(), k)


def bigram_topk_by_summaries(lines: DataFrame, k: int = 10, line_col: str = "value", capacity: int = CAPACITY) -> DataFrame:
    """:func:`bigram_topk` from per-task summaries: the shuffle carries the frequent bigrams only, the lines are read twice."""
    return top_k_items(bigrams_of_lines(lines, line_col), bigram_order(), k, capacity)
