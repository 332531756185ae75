"""Exact substring deduplication over windows of words, with a count-min prefilter.

A window's key in the sketch is its minimizer, the least hash among the ``ANCHOR_WORDS``-word spans in it: equal
windows have equal minimizers, so the minimizer's count is never below the window's. The first pass merges the sketches
of all partitions. The second pass sends only the windows that are estimated to repeat, and groups them exactly by the
64-bit hash of their word sequence to the smallest document that has them. Neighbouring windows with one minimizer are
sent and grouped as one segment; where the segments of a minimizer differ, each of their windows is grouped by itself.
The occurrences are then joined to the groups, and what they cover is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import materialised
from quarry.llm.sketch import Shared, bitmap, log2_cells, signed_hashes, split_by_key, text_bytes
from quarry.llm.textbatch import Chunk, Spans, chunks, inside, slide

WINDOW_WORDS = 13
ANCHOR_WORDS = 7
DEPTH = 2
#: Windows of one segment at most, so that its bits fall into two blocks of 64.
SEGMENT_WINDOWS = 62
#: Bytes of text to one cell of the sketch: at six bytes a word and a minimizer every four words, five cells each.
BYTES_A_CELL = 5


def _minimizers(words: Spans, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every anchor span, and the least of them in every window."""
    h = words.windows(anchor)
    return h, slide(h, window - anchor + 1)


def _anchors(chunk: Chunk, window: int, anchor: int) -> np.ndarray:
    """Hashes of the anchor spans that are the minimizer of some window."""
    start, end, first = chunk.words()
    if len(start) < window:
        return np.zeros(0, np.uint64)
    h, least = _minimizers(Spans(chunk.byte_spans().hash(start, end)), window, anchor)
    width = window - anchor + 1
    # a span is chosen if the largest minimizer of the windows around it (those within a text) is its own hash
    masked = np.where(inside(first, window), least, np.uint64(0))
    around = slide(np.concatenate([np.zeros(width - 1, np.uint64), masked, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    return h[around[: len(h)] == h]


def _segments(chunk: Chunk, window: int, anchor: int) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word spans, and of each segment: minimizer, first window, number of windows, text."""
    start, end, first = chunk.words()
    words = Spans(chunk.byte_spans().hash(start, end))
    none = np.zeros(0, np.int64)
    if len(start) < window:
        return words, none.astype(np.uint64), none, none, none
    _, least = _minimizers(words, window, anchor)
    at = np.flatnonzero(inside(first, window))
    if not len(at):
        return words, none.astype(np.uint64), none, none, none
    least = least[at]
    head = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(at) > 1))))
    # windows of two texts never follow each other: the last of a text is followed by spans that reach over its end
    n = np.diff(np.append(head, len(at)))
    pieces = -(-n // SEGMENT_WINDOWS)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head, n = np.repeat(head, pieces), np.repeat(n, pieces)
    begin = at[head] + nth * SEGMENT_WINDOWS
    return words, least[head], begin, np.minimum(n - nth * SEGMENT_WINDOWS, SEGMENT_WINDOWS), np.searchsorted(first, begin, "right") - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def removed_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS
) -> DataFrame:
    """(id, key, block, bits): the windows of a row that also start in a document with a smaller id.

    ``key`` is xxhash64 of the text; bit b of block k stands for the window that starts at word 64 * k + b. A null id
    counts as larger than all others.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("bytes"))
    id_type, long = rows.schema["id"].dataType, T.LongType()
    found = bitmap(
        rows.select("bytes"), lambda batch: (_anchors(c, window, anchor) for c in chunks(batch.column(0))), log2_cells(text_bytes(docs, text_col) // BYTES_A_CELL, 1), 2, DEPTH
    )
    estimated = Shared(spark, found)

    def read(batches: Iterator[pa.RecordBatch], give) -> Iterator[pa.RecordBatch]:
        """``give`` for the segments of each chunk whose minimizer is estimated to repeat."""
        for batch in batches:
            for c in chunks(batch.column(2)):
                words, least, begin, n, text = _segments(c, window, anchor)
                ok = np.flatnonzero(estimated.value.has(least))
                if len(ok):
                    yield from give(batch, c, words, least[ok], begin[ok], n[ok], text[ok])

    def place(batch: pa.RecordBatch, c: Chunk, at: np.ndarray, text: np.ndarray) -> list[pa.Array]:
        _, _, first = c.words()
        row = pa.array(text + c.first)
        return [batch.column(0).take(row), batch.column(1).take(row), pa.array(at - first[text])]

    place_fields = [T.StructField("id", id_type), T.StructField("key", long), T.StructField("at", long)]
    smallest = [F.min("id").alias("least"), F.max("id").alias("most"), F.max(F.col("id").isNull()).alias("some_null")]
    in_two = "least < most or (least is not null and some_null)"  # in one document only, nothing is removed
    later = "id > least or id is null"

    # segments as wholes
    def contents(batch, c, words, least, begin, n, text) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([_signed(least), _signed(words.hash(begin, begin + n + window - 1)), place(batch, c, begin, text)[0]], ["m", "c", "id"])

    content_schema = T.StructType([T.StructField("m", long), T.StructField("c", long), T.StructField("id", id_type)])
    groups = materialised(rows.mapInArrow(lambda batches: read(batches, contents), content_schema).groupBy("m", "c").agg(*smallest))
    several = materialised(groups.groupBy("m").agg(F.min("c").alias("c"), F.max("c").alias("d")).filter("c <> d").select("m"))
    mixed = Shared(spark, 
        bitmap(several, lambda batch: [signed_hashes(batch.column(0))], log2_cells(several.count(), 16), 1)
    )

    def segments(batch, c, words, least, begin, n, text) -> Iterator[pa.RecordBatch]:
        alike = ~mixed.value.has(least)
        least, begin, n, text = least[alike], begin[alike], n[alike], text[alike]
        yield pa.RecordBatch.from_arrays([_signed(least), _signed(words.hash(begin, begin + n + window - 1)), *place(batch, c, begin, text), pa.array(n.astype(np.int32))], segment_schema.names)

    segment_schema = T.StructType([T.StructField("m", long), T.StructField("c", long), *place_fields, T.StructField("n", T.IntegerType())])
    whole = rows.mapInArrow(lambda batches: read(batches, segments), segment_schema).join(groups.filter(in_two).select("m", "c", "least").hint("shuffle_hash"), ["m", "c"]).filter(later)
    halves = F.expr(
        """array(named_struct('block', `at` div 64, 'bits', shiftleft(shiftleft(1L, n) - 1, cast(`at` % 64 as int))),
                 named_struct('block', `at` div 64 + 1, 'bits', if(`at` % 64 = 0, 0L, shiftrightunsigned(shiftleft(1L, n) - 1, cast(64 - `at` % 64 as int)))))"""
    )
    whole = whole.select("id", "key", F.explode(halves).alias("b")).select("id", "key", "b.block", "b.bits").filter("bits <> 0")

    # single windows of the minimizers with several contents
    def single(batch, c, words, least, begin, n, text) -> Iterator[pa.RecordBatch]:
        ragged = mixed.value.has(least)
        begin, n, text = begin[ragged], n[ragged], text[ragged]
        at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays([_signed(words.hash(at, at + window)), *place(batch, c, at, np.repeat(text, n))], window_schema.names)

    window_schema = T.StructType([T.StructField("h", long), *place_fields])
    windows = rows.mapInArrow(lambda batches: read(batches, single), window_schema)
    least = materialised(windows.groupBy("h").agg(*smallest).filter(in_two).select("h", "least"))  # so that a hot window's join can be split
    ragged = windows.join(least.hint("shuffle_hash"), "h").filter(later)
    ragged = ragged.select("id", "key", F.expr("`at` div 64").alias("block"), F.expr("shiftleft(1L, cast(`at` % 64 as int))").alias("bits"))
    return whole.unionAll(ragged).groupBy("id", "key", "block").agg(F.expr("bit_or(bits)").alias("bits"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 (and ``kept_text``, if asked for).

    A word goes if a window over it has a word sequence that also starts in a document with a smaller id. Repeats
    within one document, or between rows of the same id, remove nothing. A null id counts as larger than all others; rows
    without an id don't remove words from one another. Null and wordless texts have no words and an empty kept text.
    Other columns are ignored. An empty table gives an empty result.
    """
    gone = removed_words(docs, id_col, text_col, window, anchor)
    gone = materialised(gone.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list(F.struct("block", "bits")).alias("gone")))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("bytes"))
    changed, same = split_by_key(rows, gone.select(F.col("_key").alias("key")))
    joined = changed.join(gone, changed["id"].eqNullSafe(F.col("_id")) & (changed["key"] == F.col("_key")), "left").select("id", "bytes", "gone.block", "gone.bits")
    none = F.lit(None).cast("array<bigint>")
    joined = joined.unionAll(same.select("id", "bytes", none.alias("block"), none.alias("bits")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha, text = [], [], [], []
            for data, block, bits in zip(*(batch.column(k) for k in (1, 2, 3))):
                words = (data.as_py() or b"").split()
                n = len(words)
                keep = words
                if block.is_valid:
                    covered = np.zeros(64 * (n // 64 + 1) + window, np.int32)
                    low = np.zeros(64 * (n // 64 + 1), np.uint8).reshape(-1, 64)
                    low[block.values.to_numpy()] = np.unpackbits(bits.values.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    at = np.flatnonzero(low)
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + window, -1)
                    off = np.cumsum(covered)[:n] > 0
                    keep = [words[i] for i in np.flatnonzero(~off)]
                kept = b" ".join(keep)
                n_words.append(n)
                n_removed.append(n - len(keep))
                sha.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    text.append(kept.decode())
            arrays = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(text, pa.string())] * with_text, [f.name for f in schema])

    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
        + [T.StructField("kept_text", T.StringType())] * with_text
    )
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
