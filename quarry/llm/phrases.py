"""Phrase collocations per language, from counts of the longest windows only.

Texts are cut into pieces at punctuation and line breaks, pieces into words. Steps:

1. Pairs of neighbouring words are counted in a sketch (never too low); a bit a cell says whether a pair may be frequent.
   Then triples of such pairs are.
2. Every word begins one window: itself and lead columns with the words after it, as far as the piece goes and the pairs
   and triples may be frequent, and padding behind. Only these windows are counted, first within a task. A phrase that is
   frequent has frequent pairs and triples only, so no occurrence of it is cut short.
3. One ``ROLLUP`` over (language, first word, ..., last word) sums them to the counts of all shorter prefixes: every phrase
   is the prefix of the windows that begin with it, a word is the shortest prefix, and the language's total is n.
4. Frequent phrases find the counts of both parts of each cut by equi-joins. A phrase goes if a phrase of one word more
   has its count; longer ones say nothing new, since counts fall with length.
5. The texts are read once more for the words of the phrases that are returned.

Words are compared by 64-bit hashes. Counts, products and quotients are whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import materialised
from quarry.llm.sketch import Bitmap, Shared, bitmap, log2_cells, signed_hashes, text_bytes
from quarry.llm.textbatch import Chunk, chunks, mix, owner

WORDS, MIN_COUNT, TOP = 5, 100, 2000
#: Phrases of up to so many words have a sketch.
SKETCHED = 3
#: Bytes of text to one cell of a sketch (at most 2**MAX_LOG2_CELLS, so a broadcast has 16 MB at most). A full sketch only
#: lets more windows through.
BYTES_A_CELL, MAX_LOG2_CELLS = 64, 27
#: Windows that a task counts before it sends them.
GATHER = 400_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 1 for the bytes that end a word, 2 for those that end a piece too: . , ; : ! ? and 0x0A to 0x0D.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = 2


class _Words:
    """Words of a chunk, A-Z in lower case: hash (never 0), text, and whether the next word is in the same piece."""

    def __init__(self, chunk: Chunk) -> None:
        self.data = _LOWER[chunk.data]
        kind = _KIND[self.data]
        inside = kind == 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(inside))]
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(self.start, chunk.offsets)
        self.text = owner(first) + chunk.first
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        at = breaks[self.start] if len(self.start) else np.zeros(0, np.int32)
        self.joined = np.zeros(len(at), bool)
        self.joined[:-1] = (at[1:] == at[:-1]) & (self.text[1:] == self.text[:-1])
        self.h = Chunk(self.data, chunk.offsets, chunk.first).byte_spans().hash(self.start, self.end)
        self.h[self.h == 0] = 1

    def after(self, values: np.ndarray, k: int) -> np.ndarray:
        """The value of the word k places on, 0 behind the last one."""
        return np.append(values[k:], np.zeros(min(k, len(values)), values.dtype))

    def phrases(self, lang: np.ndarray, sketches: list[Bitmap], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 2, 3, ... words from each word on: may they be a frequent phrase, and its hash with ``lang``, the language's hash for each text.

        They may if both shorter phrases in them may, and the sketch of their length, if there is one, has counted enough.
        """
        key, may = mix(self.h + mix(lang[self.text])), self.joined
        for m in range(2, width + 1):
            key = mix(key + self.after(self.h, m - 1))
            may = may & self.after(may, 1) if m > 2 else may.copy()
            if m - 2 < len(sketches):
                at = np.flatnonzero(may)
                may[at] = sketches[m - 2].has(key[at])
            yield may, key


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", width: int = WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, g, f): word hashes of every phrase of up to ``width`` words with ``min_count`` occurrences, and with an empty ``g`` the number of all words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("bytes"))
    rows = rows.withColumn("h", F.xxhash64("lang"))

    log2 = min(MAX_LOG2_CELLS, log2_cells(text_bytes(docs, text_col) // BYTES_A_CELL, 1))
    sketches: list[Shared] = []

    def longest(batch: pa.RecordBatch, shared: list[Shared]) -> Iterator[np.ndarray]:
        """Hashes of the phrases of one word more than the sketches so far are for."""
        lang = signed_hashes(batch.column(1))
        for c in chunks(batch.column(0)):
            *_, (may, key) = _Words(c).phrases(lang, [x.value for x in shared], len(shared) + 2)
            yield key[may]

    for _ in range(min(SKETCHED, width) - 1):
        found = bitmap(rows.select("bytes", "h"), lambda batch, shared=tuple(sketches): longest(batch, shared), log2, min_count)
        sketches.append(Shared(docs.sparkSession, found))
    names = [f"w{k + 1}" for k in range(width)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        waiting: list[list[np.ndarray]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            if waiting:
                columns = [np.concatenate(c) for c in zip(*waiting)]
                waiting.clear()
                key = columns[0].astype(np.uint64)
                for c in columns[1:]:
                    key = mix(key + c)
                _, at, n = np.unique(key, return_index=True, return_counts=True)
                lang = pa.array(list(langs), pa.string()).take(pa.array(columns[0][at]))
                yield pa.RecordBatch.from_arrays([lang, *(pa.array(c[at].view(np.int64)) for c in columns[1:]), pa.array(n.astype(np.int64))], ["lang", *names, "c"])

        size = 0
        for batch in batches:
            code = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int64)
            lang = signed_hashes(batch.column(2))
            for c in chunks(batch.column(1)):
                words = _Words(c)
                lead = [np.where(may, words.after(words.h, k), np.uint64(0)) for k, (may, _) in enumerate(words.phrases(lang, [x.value for x in sketches], width), 1)]
                waiting.append([code[words.text], words.h, *lead])
                size += len(words.h)
                if size >= GATHER:
                    yield from sent()
                    size = 0
        yield from sent()

    windows = rows.mapInArrow(count, T.StructType([T.StructField("lang", T.StringType()), *(T.StructField(c, T.LongType()) for c in [*names, "c"])]))
    counted = windows.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("left_out"))
    whole = []  # the last word of a prefix is no padding
    for k in range(1, width + 1):
        whole.append(f"left_out = {(1 << (width - k)) - 1} and f >= {min_count} and {names[k - 1]} <> 0")
    counted = counted.filter(f"left_out = {(1 << width) - 1} or {' or '.join(f'({w})' for w in whole)}")
    return counted.select("lang", F.expr(f"filter(array({', '.join(names)}), w -> w is not null)").alias("g"), "f")


def _decoded(docs: DataFrame, hashes: DataFrame, text_col: str) -> DataFrame:
    """(h, word) of the words whose hashes are wanted."""
    wanted = Shared(docs.sparkSession, bitmap(hashes, lambda batch: [signed_hashes(batch.column(0))], log2_cells(hashes.count(), 16), 1))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use: Bitmap = wanted.value
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for c in chunks(batch.column(0)):
                words = _Words(c)
                h, at = np.unique(words.h, return_index=True)
                new = use.has(h) & ~np.isin(h, seen)
                h, at = h[new], at[new]
                if len(h):
                    seen = np.union1d(seen, h)
                    spelt = [words.data[a:b].tobytes().decode() for a, b in zip(words.start[at], words.end[at])]
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(spelt, pa.string())], ["h", "word"])

    return docs.select(F.col(text_col).cast("binary")).mapInArrow(spell, "h bigint, word string").dropDuplicates(["h"])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", width: int = WORDS, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    a is the phrase's count, l and r those of its two parts at the cut of the lowest score (of equal ones the first), n the
    words of the language, score floor(1000 a n / (l r)). Ordered by score, then a, both falling, then the phrase in byte
    order. Phrases within a longer one of the same count are dropped. Null texts are empty; a null language counts as
    ``und``, together with one that is called so. Repeated rows count as often as they occur. Languages without a
    frequent phrase have no rows; other columns are ignored. An empty table gives an empty result.
    """
    counts = materialised(phrase_counts(docs, text_col, lang_col, width, min_count))
    totals = counts.filter("size(g) = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("size(g) > 1").select("lang", "g", F.col("f").alias("a"))
    parts = F.array(F.expr("slice(g, 1, size(g) - 1)"), F.expr("slice(g, 2, size(g) - 1)"))
    longest = phrases.filter("size(g) > 2").select("lang", F.explode(parts).alias("g"), "a").groupBy("lang", "g").agg(F.max("a").alias("longer"))
    own = phrases.join(longest, ["lang", "g"], "left").filter("longer is null or 100 * longer < 100 * a").drop("longer")
    cuts = own.select("*", F.explode(F.expr("sequence(1, size(g) - 1)")).alias("k")).select("*", F.expr("slice(g, 1, k)").alias("head"), F.expr("slice(g, k + 1, size(g))").alias("tail"))
    cuts = cuts.join(counts.select("lang", F.col("g").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(counts.select("lang", F.col("g").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]).join(totals, "lang")
    a, n, l, r = (F.col(c).cast("decimal(19,0)") for c in "anlr")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, l * r)
    least = cuts.groupBy("lang", "g", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")).select("lang", "g", "a", "n", "b.score", "b.l", "b.r")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = materialised(least.withColumn("place", F.rank().over(first)).filter(F.col("place") <= top).drop("place"))
    words = _decoded(docs, best.select(F.explode("g").alias("h")).distinct(), text_col)
    spelt = best.select("*", F.posexplode("g").alias("at", "h")).join(words, "h").groupBy("lang", "g").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    named = best.join(spelt.select("lang", "g", F.concat_ws(" ", "words.word").alias("phrase")), ["lang", "g"])
    ranked = named.withColumn("rank", F.row_number().over(first.orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")).filter(F.col("rank") <= top)
    return ranked.select(F.col("lang").alias(lang_col), "rank", "phrase", "a", "l", "r", "n", "score")
