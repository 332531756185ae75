"""Removal of long repeated byte strings with suffix arrays built by two-stage sorting.

A string of ``length`` bytes that repeats is found in three steps.

1. Windows are dealt by their minimizer, the least hash among the ``anchor``-byte spans in them; equal windows have
   equal minimizers. Neighbouring windows with one minimizer form a segment. A merged count-min sketch first rules out
   the minimizers that occur once in the whole corpus.
2. Segments of equal content are counted together before anything is sorted. Where all segments of a minimizer have
   the same content, its windows repeat if it occurs twice. Where contents differ, one copy of each goes to the
   bucket of the minimizer, and the bucket's suffixes are sorted: those smaller than their successor directly, by
   their first ``length`` bytes, all others by scanning the buckets of first bytes in order. Two neighbours in that
   order with a common prefix of ``length`` bytes are a repeat, and so is a window of a segment that has copies.
3. A minimizer with more than ``hot_contents`` different contents would be too much for one task: its windows are
   hashed and counted exactly instead, one by one, so that a passage shared by very many documents spreads over all
   tasks.

The verdicts are joined to all occurrences of the segments; what the repeated windows cover is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import materialised
from quarry.llm.sketch import Shared, bitmap, log2_cells, signed_hashes, split_by_key, text_bytes
from quarry.llm.textbatch import Chunk, Spans, chunks, inside, runs, slide

LENGTH = 200
ANCHOR = 100
HOT_CONTENTS = 5_000
#: Bytes of segments that a bucket holds on average.
BUCKET_BYTES = 1 << 20
#: Windows of one segment; a longer run of one minimizer is cut.
SEGMENT_WINDOWS = 4096


# --- suffix array ------------------------------------------------------------------------------------------------


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All positions of ``text`` (uint8), ordered by at least the first ``depth`` bytes of the suffix there."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # a suffix is smaller than its successor if the next byte that differs from its first is larger
    change = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(change, n - 1)  # last position of each run of one byte
    rises = np.append(text[change] < text[change + 1], False)
    smaller = np.repeat(rises, np.diff(np.concatenate(([-1], ends))))
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    keys = np.ndarray(n, f"S{depth}", padded, strides=(1,))

    size = np.bincount(text, minlength=256)
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    end = start + size
    order = np.full(n, -1, np.int64)
    n_direct = np.bincount(text[smaller], minlength=256)
    for byte in np.flatnonzero(n_direct):  # the smaller ones stand at the end of the bucket of their first byte
        direct = np.flatnonzero(smaller & (text == byte))
        order[end[byte] - n_direct[byte] : end[byte]] = direct[np.argsort(keys[direct], kind="stable")]
    head = start.copy()
    order[head[text[-1]]] = n - 1
    head[text[-1]] += 1

    def induce(block: np.ndarray) -> None:
        """Put the predecessors that aren't smaller than the suffixes of the block next in their buckets."""
        before = block[block > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        edges = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(first) else []
        for lo, hi in zip(edges, [*edges[1:], len(first)]):
            byte = first[lo]
            order[head[byte] : head[byte] + hi - lo] = before[lo:hi]
            head[byte] += hi - lo

    for byte in np.flatnonzero(size):
        done = start[byte]
        while done < head[byte]:  # a run of this byte adds to its own bucket
            block = order[done : head[byte]].copy()
            done = head[byte]
            induce(block)
        induce(order[end[byte] - n_direct[byte] : end[byte]])
    return order


def repeated_windows(segments: list[bytes], length: int) -> np.ndarray:
    """Flags of the positions of the joined segments whose window of ``length`` bytes, within one segment, occurs there twice."""
    text = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    whole = ends - np.arange(len(text)) >= length
    order = suffix_array(text, length)
    order = order[whole[order]]
    a, b = order[:-1], order[1:]
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(text), ">u8", padded, strides=(1,))
    common = np.zeros(len(a), np.int64)  # of neighbours, up to the window's length
    live = np.arange(len(a))
    for done in range(0, length - length % 8, 8):
        live = live[eight[a[live] + done] == eight[b[live] + done]]
        common[live] = done + 8
    for done in range(length - length % 8, length):
        live = live[text[a[live] + done] == text[b[live] + done]]
        common[live] = done + 1
    flags = np.zeros(len(text), bool)
    same = common >= length
    flags[a[same]] = True
    flags[b[same]] = True
    return flags


# --- segments ----------------------------------------------------------------------------------------------------


@dataclass
class _Segments:
    minimizer: np.ndarray
    content: np.ndarray  # hash
    text: np.ndarray  # number in the chunk
    start: np.ndarray  # byte in the chunk
    windows: np.ndarray
    twice: np.ndarray  # whether the minimizer stands at two places in it


def _least(chunk: Chunk, length: int, anchor: int, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes, and the minimizer of each window (0 where the window isn't within one text)."""
    h = spans.windows(anchor)
    return h, np.where(inside(chunk.offsets, length), slide(h, length - anchor + 1), np.uint64(0))


def _chosen(h: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Flags of the anchors that are some window's minimizer."""
    edge = np.zeros(width - 1, np.uint64)
    return slide(np.concatenate([edge, least, edge]), width, np.maximum)[: len(h)] == h


def _segments(chunk: Chunk, length: int, anchor: int, spans: Spans, places: bool = False) -> _Segments:
    """The segments of a chunk; ``twice`` is found only if ``places`` is set."""
    n = len(chunk.data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return _Segments(none.astype(np.uint64), none.astype(np.uint64), none, none, none, none.astype(bool))
    h, least = _least(chunk, length, anchor, spans)
    ok = inside(chunk.offsets, length)
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])))
    text_start = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < n)]
    new[text_start] = True
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, n))
    start, windows = start[ok[start]], windows[ok[start]]
    at = np.flatnonzero(_chosen(h, least, length - anchor + 1)) if places else none
    pair = np.flatnonzero((h[at[1:]] == h[at[:-1]]) & (np.diff(at) <= length - anchor + 1)) if len(at) > 1 else none  # the windows of places so far apart still touch
    twice = np.zeros(len(start), bool)
    for_pair = np.searchsorted(start, np.maximum(at[pair + 1] - (length - anchor), 0) if len(pair) else none, "right") - 1 if len(start) else none
    for shift in (0, 1):  # the window that ends with the pair may be the first of the next segment
        seg = np.minimum(for_pair + shift, len(start) - 1)
        seg = seg[seg >= 0]
        twice[seg] = True
    cut = np.repeat(np.arange(len(start)), -(-windows // SEGMENT_WINDOWS))
    nth = np.arange(len(cut)) - np.searchsorted(cut, cut)
    start, windows, twice = start[cut] + nth * SEGMENT_WINDOWS, np.minimum(windows[cut] - nth * SEGMENT_WINDOWS, SEGMENT_WINDOWS), twice[cut]
    text = np.searchsorted(chunk.offsets, start, "right") - 1
    return _Segments(least[start], spans.hash(start, start + windows + length - 1), text, start, windows, twice)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, hot_contents: int = HOT_CONTENTS) -> DataFrame:
    """(id, key, start, end): byte spans of a row that repeated strings cover, one or more for a segment; ``key`` is xxhash64 of the text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("bytes"))
    size = text_bytes(docs, text_col)
    per_anchor = (length - anchor + 2) // 2

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for c in chunks(batch.column(0)):
            if len(c.data) >= length:
                h, least = _least(c, length, anchor, c.byte_spans())
                yield h[_chosen(h, least, length - anchor + 1)]

    repeated = Shared(spark, bitmap(rows.select("bytes"), anchors, log2_cells(size // per_anchor), 2, 1))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column(2)):
                s = _segments(c, length, anchor, c.byte_spans(), places=True)
                at = np.flatnonzero(repeated.value.has(s.minimizer))
                row = pa.array(s.text[at] + c.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(s.minimizer[at]), _signed(s.content[at]), batch.column(0).take(row), batch.column(1).take(row),
                        pa.array(s.start[at] - c.offsets[s.text[at]]), pa.array(s.windows[at].astype(np.int32)), pa.array(s.twice[at]),
                    ],
                    names,
                )

    schema = T.StructType(
        [
            T.StructField("m", T.LongType()), T.StructField("c", T.LongType()), T.StructField("id", rows.schema["id"].dataType), T.StructField("key", T.LongType()),
            T.StructField("start", T.LongType()), T.StructField("windows", T.IntegerType()), T.StructField("twice", T.BooleanType()),
        ]
    )
    names = schema.names
    occurrences = materialised(rows.mapInArrow(found, schema))
    contents = materialised(occurrences.groupBy("m", "c").agg(F.count("*").alias("n"), F.max("twice").alias("twice"), F.max("windows").alias("windows")))
    minimizers = contents.groupBy("m").agg(F.count("*").alias("contents"), F.sum("n").alias("total"), F.max("twice").alias("any_twice"))
    kind = F.when(F.col("contents") > hot_contents, "hot").when(F.col("contents") > 1, "sort").when(F.col("total") > 1, "whole").when(F.col("any_twice"), "sort")
    minimizers = minimizers.select("m", kind.alias("kind")).filter("kind is not null")
    settled = materialised(contents.join(minimizers, "m"))
    whole = settled.filter("n > 1").select("m", "c", F.array(F.struct(F.lit(0).alias("lo"), F.col("windows").alias("hi"))).alias("repeats"))

    # one copy of each single content that must be sorted against others, and of their partners
    open_ = settled.filter("kind <> 'whole'")
    of_kind = {r["kind"]: (r["n"], r["bytes"]) for r in open_.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.col("windows") + length - 1).alias("bytes")).collect()}
    verdicts = [whole]
    if of_kind:
        wanted = {}
        for name, (n, _) in of_kind.items():
            cells = open_.filter(F.col("kind") == name).select("c")
            wanted[name] = bitmap(cells, lambda batch: [signed_hashes(batch.column(0))], log2_cells(n, 16), 1)
        wanted = {name: Shared(spark, found) for name, found in wanted.items()}

        def chosen(kind: str, batches: Iterator[pa.RecordBatch], give) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for c in chunks(batch.column(0)):
                    spans = c.byte_spans()
                    s = _segments(c, length, anchor, spans)
                    at = np.flatnonzero(repeated.value.has(s.minimizer) & wanted[kind].value.has(s.content))
                    if len(at):
                        at = at[np.unique(s.content[at], return_index=True)[1]]
                        yield give(c, spans, s, at)

        if "sort" in of_kind:

            def texts(c: Chunk, _: Spans, s: _Segments, at: np.ndarray) -> pa.RecordBatch:
                raw = c.data.tobytes()
                content = [raw[a : a + w] for a, w in zip(s.start[at].tolist(), (s.windows[at] + length - 1).tolist())]
                return pa.RecordBatch.from_arrays([_signed(s.minimizer[at]), _signed(s.content[at]), pa.array(content, pa.binary())], ["m", "c", "content"])

            buckets = max(1, of_kind["sort"][1] // BUCKET_BYTES)

            def sort(table: pa.Table) -> pa.Table:
                content, n = table["content"].to_pylist(), table["n"].to_numpy()
                flags = repeated_windows(content, length)
                repeats, at = [], 0
                for text, copies in zip(content, n):
                    own = flags[at : at + len(text) - length + 1]
                    at += len(text)
                    lo, hi = runs(own if copies == 1 else np.ones(len(own), bool))
                    repeats.append([{"lo": int(a), "hi": int(b)} for a, b in zip(lo, hi)])
                kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
                return pa.table({"m": table["m"], "c": table["c"], "repeats": pa.array(repeats, kind)})

            copies = rows.select("bytes").mapInArrow(lambda b: chosen("sort", b, texts), "m bigint, c bigint, content binary").dropDuplicates(["m", "c"])
            sorted_ = copies.join(open_.filter("kind = 'sort'").select("m", "c", "n"), ["m", "c"])
            sorted_ = sorted_.withColumn("bucket", F.pmod(F.xxhash64("m"), F.lit(buckets))).groupBy("bucket").applyInArrow(sort, "m bigint, c bigint, repeats array<struct<lo int, hi int>>")
            verdicts.append(sorted_.filter(F.size("repeats") > 0).join(whole.select("m", "c"), ["m", "c"], "left_anti"))

        if "hot" in of_kind:

            def hashes(c: Chunk, spans: Spans, s: _Segments, at: np.ndarray) -> pa.RecordBatch:
                n = s.windows[at]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(s.start[at], n) + nth
                repeat = np.repeat(at, n)
                return pa.RecordBatch.from_arrays([_signed(s.minimizer[repeat]), _signed(s.content[repeat]), pa.array(nth.astype(np.int32)), _signed(spans.hash(start, start + length))], ["m", "c", "lo", "w"])

            single = rows.select("bytes").mapInArrow(lambda b: chosen("hot", b, hashes), "m bigint, c bigint, lo int, w bigint").distinct()
            single = single.join(open_.filter("kind = 'hot'").select("m", "c"), ["m", "c"], "left_semi")
            twice = single.groupBy("w").agg(F.count("*").alias("times")).filter("times > 1").select("w")
            hot = single.join(twice, "w").groupBy("m", "c").agg(F.collect_list(F.struct("lo", (F.col("lo") + 1).alias("hi"))).alias("repeats"))
            verdicts.append(hot.join(whole.select("m", "c"), ["m", "c"], "left_anti"))

    verdict = verdicts[0]
    for more in verdicts[1:]:
        verdict = verdict.unionAll(more)
    return (
        occurrences.select("m", "c", "id", "key", "start")
        .join(verdict, ["m", "c"])
        .select("id", "key", "start", F.explode("repeats").alias("r"))
        .select("id", "key", (F.col("start") + F.col("r.lo")).alias("start"), (F.col("start") + F.col("r.hi") + length - 1).alias("end"))
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, hot_contents: int = HOT_CONTENTS, with_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans (removed runs), kept_sha256 (and ``kept``, if asked for).

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in this text or another; strings are
    judged on the input. Null and empty texts have no bytes. Rows that repeat an id or a text are texts of their own, so
    copies remove each other whole. Null ids are kept. Other columns are ignored. An empty table gives an empty result.
    """
    spans = repeated_bytes(docs, id_col, text_col, length, anchor, hot_contents)
    spans = materialised(spans.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_set(F.struct("start", "end")).alias("gone")))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("bytes"))
    changed, same = split_by_key(rows, spans.select(F.col("_key").alias("key")))
    joined = changed.join(spans, changed["id"].eqNullSafe(F.col("_id")) & (changed["key"] == F.col("_key")), "left").select("id", "bytes", "gone.start", "gone.end")
    none = F.lit(None).cast("array<bigint>")
    joined = joined.unionAll(same.select("id", "bytes", none.alias("start"), none.alias("end")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for data, start, end in zip(*(batch.column(k) for k in (1, 2, 3))):
                raw = data.as_py() or b""
                kept, removed, spans = raw, 0, 0
                if start.is_valid:
                    depth = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(depth, start.values.to_numpy(), 1)
                    np.add.at(depth, end.values.to_numpy(), -1)
                    off = np.cumsum(depth[:-1]) > 0
                    kept, removed, spans = np.frombuffer(raw, np.uint8)[~off].tobytes(), int(off.sum()), len(runs(off)[0])
                for column, value in zip(out, (len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            arrays = [batch.column(0), *(pa.array(v, pa.int64()) for v in out[:3]), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(out[4], pa.binary())] * with_bytes, [f.name for f in schema])

    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())]
        + [T.StructField("kept", T.BinaryType())] * with_bytes
    )
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
