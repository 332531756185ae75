"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Only the lengths decide a packing, so it is planned on their histogram (at most ``capacity`` rows, whatever the
corpus). A bin is filled greedily, always with the longest piece that still fits; then, while a gap is left, its
smallest piece is replaced by the two unpacked pieces that fit the gap so expanded most tightly. The same bin is
repeated as long as its lengths last, which gives a short list of slots (length, ranks from - to, bin, offset). Each
piece has a rank within its length: a count within its task plus the counts of the tasks before.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import materialised

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task remembers; it starts afresh when there are more.
MEMO_WORDS = 1 << 18
_RANK_BITS = 40


#: Symbols that the tokenizer always cuts from the letters before them.
_SYMBOLS = ".,;:!?%&$*#|"


class _WordIds:
    """Ids of words as little-endian unsigned 32-bit numbers, each word encoded once.

    The tokenizer never joins characters over white space, nor letters with the symbols after them, and it lower-cases
    first. So a word of letters (below U+0250, where lower-casing and composition go character by character) and
    symbols takes the ids of its lower-cased letters, which go to the tokenizer's model in the byte alphabet, and those
    of its symbols. All other words are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ids: dict[str, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256
        self.alphabet = {x: x for x in shown} | {x: 256 + i for i, x in enumerate(sorted({*range(256)} - {*shown}))}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        own = array("I", ids)
        if sys.byteorder == "big":
            own.byteswap()
        return own.tobytes()

    def _learn(self, words: list[str]) -> None:
        ids, rest = self.ids, []
        for word in words:
            letters = word.rstrip(_SYMBOLS)
            low = letters.lower()
            if not low.isalpha() or not (low.isascii() or max(low) < "\u0250"):
                rest.append(word)
                continue
            if low not in ids:
                shown = low if low.isascii() else low.encode().decode("latin-1").translate(self.alphabet)
                ids[low] = self._packed([t.id for t in self.model.tokenize(shown)])
            symbols = word[len(letters) :]
            if symbols and symbols not in ids:
                ids[symbols] = self._packed(self.tokenizer.encode(symbols, add_special_tokens=False).ids)
            ids[word] = ids[low] + ids[symbols] if symbols else ids[low]
        for lo in range(0, len(rest), 20_000):
            part = rest[lo : lo + 20_000]
            for word, encoding in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                ids[word] = self._packed(encoding.ids)

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        split = [(t or "").replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        if len(self.ids) > MEMO_WORDS:
            self.ids = {}
        known = self.ids
        self._learn([w for w in {w for words in split for w in words} if w not in known])
        for words in split:
            yield b"".join(map(known.__getitem__, words))


def _word_ids(path: str) -> _WordIds:
    """The tokenizer is kept for the life of a Python worker."""
    kept = sys.modules.setdefault("_quarry_word_ids", SimpleNamespace(by_path={}))
    if path not in kept.by_path:
        kept.by_path[path] = _WordIds(path)
    return kept.by_path[path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, its task ``shard`` and its number ``nth`` of that length there (and ``ids`` as bytes)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64).tolist()
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                own = batch.slice(at, 500)
                row, piece, length, crc, nth, ids = [], [], [], [], [], []
                for i, data in enumerate(_word_ids(tokenizer_path).of(own.column(1).to_pylist())):
                    data += end
                    for k, lo in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[lo : lo + 4 * capacity]
                        n = len(part) // 4
                        row.append(i)
                        piece.append(k)
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        nth.append(seen[n])
                        seen[n] += 1
                        if with_ids:
                            ids.append(part)
                arrays = [
                    own.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array([capacity * k for k in piece], pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([shard] * len(row), pa.int32()), pa.array(nth, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * with_ids, [f.name for f in schema])
        _word_ids(tokenizer_path).ids = {}  # an idle worker holds the tokenizer only

    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("nth", T.LongType()),
        ] + [T.StructField("ids", T.BinaryType())] * with_ids
    )
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(cut, schema)


def _pair(lengths: np.ndarray, left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two available lengths with the largest sum up to ``room``."""
    first = lengths[lengths < room]
    if not len(first):
        return None
    at = np.searchsorted(lengths, room - first, "right") - 1
    single = (at >= 0) & (lengths[at] == first) & (left[first] < 2)
    at = np.where(single, at - 1, at)
    total = np.where(at >= 0, first + lengths[at], 0)
    best = int(total.argmax())
    return (int(first[best]), int(lengths[at[best]])) if total[best] else None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[str, np.ndarray], int]:
    """Slots (length, first rank, pieces a bin, first bin, offset) sorted by (length, rank), and the number of bins."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    used_up = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while left.any():
        free = left.copy()
        taken: dict[int, int] = {}

        def take(length: int, n: int) -> None:
            taken[length] = taken.get(length, 0) + n
            free[length] -= n

        lengths = np.flatnonzero(free)
        take(int(lengths[-1]), 1)
        gap = capacity - int(lengths[-1])
        while gap > 0:
            lengths = np.flatnonzero(free[: gap + 1])
            if not len(lengths):
                break
            longest = int(lengths[-1])
            n = min(gap // longest, int(free[longest]))
            take(longest, n)
            gap -= n * longest
        while gap > 0:
            smallest = min(taken)
            found = _pair(np.flatnonzero(free), free, gap + smallest)
            if not found or sum(found) <= smallest:
                break
            take(smallest, -1)
            if not taken[smallest]:
                del taken[smallest]
            for length in found:
                take(length, 1)
            gap += smallest - sum(found)
        times = min(int(left[length]) // n for length, n in taken.items())
        offset = 0
        for length in sorted(taken, reverse=True):
            n = taken[length]
            slots.append((length, int(used_up[length]), n, bins, offset))
            offset += n * length
            used_up[length] += n * times
            left[length] -= n * times
        bins += times
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(("length", "rank", "each", "bin", "offset"))}, bins


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``, if asked for).

    A document is its ids followed by ``end_id``; only longer ones than ``capacity`` are cut. Null and empty texts are
    the end id alone; a null id is kept. Repeated rows are packed as often as they occur. Pieces of equal length are
    interchangeable and take slots in order of task and place in it. Other columns are ignored. An empty table gives
    an empty result.
    """
    cut = materialised(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids))
    counts = cut.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = counts.select("length", "shard", (F.sum("n").over(Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    slots, _ = plan(histogram, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(slots)
    ranked = cut.join(before, ["length", "shard"]).withColumn("rank", F.col("nth") + F.col("before"))
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        starts = (own["length"] << _RANK_BITS) + own["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (length << _RANK_BITS) + rank, "right") - 1
            number = rank - own["rank"][at]
            sequence = own["bin"][at] + number // own["each"][at]
            offset = own["offset"][at] + number % own["each"][at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = T.StructType([*(ranked.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*names, "rank").mapInArrow(place, schema).withColumnRenamed("id", id_col)
