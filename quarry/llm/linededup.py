"""Line deduplication by an exact set-similarity join over lines.

A line (between line feeds) is the set of its words; two lines match at a Jaccard similarity of at least 0.8, and a
line goes if one before it, by document id and line number, matches. Steps:

1. Word counts of the corpus are merged into a sketch of one byte a cell, of at most 16 MiB; it orders parts of lines by
   rarity (any fixed order is exact, the rarest first is the fastest).
2. Equal lines are one, at the place of the first of them.
3. The words of each different line are dealt into parts by hash, about 1.6 to 3.2 words in each. Lines that match differ in
   a ninth of their words together, so in no more parts than that, and share one of the rarest parts of each (prefix filter
   over parts). A part is several words, so few other lines have it; those that a second sketch has counted once are left out.
   The others are posted and written once, as arrays of bytes, one row for a task's postings in a share of the parts.
4. Postings of one part meet in a task that applies the length filter and compares bitmaps of the word sets, which bound
   the overlap from above: 64 parity bits, and beyond 96 words up to 512. Postings of parts of very frequent words are dealt out by
   ranges of sizes as well. Each line asks those before it, from the first on, until a few may match (``ROUNDS``); if none
   of these does, it asks for more in the next round, and in the last one all. After the first round only postings that an
   asking line can meet are sent.
5. The pairs that are left are verified on the word sets themselves, and the lines of matched sets and later copies are cut
   out.

Words and lines are compared by 64-bit hashes. An Arrow batch size is set for the session if it has none (``BATCH_BYTES``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import fresh, materialised
from quarry.llm.sketch import Bitmap, Levels, Shared, bitmap, levels, log2_cells, signed_hashes, split_by_key, text_bytes
from quarry.llm.textbatch import Chunk, Spans, chunks, mix

#: Similarity as a fraction of whole numbers, so that the bounds are exact.
NUMERATOR, DENOMINATOR = 4, 5
BYTES_A_CELL = 32
#: Sketch level from which a word's postings are dealt out by length (about 16,000 words).
FREQUENT = 8 * 14
#: Bytes of text for each part that postings are dealt to.
PART_BYTES = 16_000_000
#: Postings that a task gathers before it sends them.
GATHER = 150_000
SMALL_GROUP = 64
#: Postings of one word that ask, and that are asked, at once.
ASKING, ASKED = 256, 1024
#: Pairs that a task gathers before it sends them.
GATHER_PAIRS = 500_000
#: Cells of the rarity sketch at most, as a power of two: beyond it the order is coarser, but any order is exact.
MAX_LOG2_RARITY = 24
#: Bytes of text for each part of a line that is sent, about.
BYTES_A_TOKEN = 26
#: Most longs of parity bits of a set of more than 32 words.
WIDE = 8
#: Bytes of an Arrow batch that a task sends to its Python worker, unless the session says so: batches of 10,000 whole texts would fill an executor.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
#: Lines that may match that a line looks for with one part, in each round.
ROUNDS = (2, None)


class _Lines:
    """Lines of a chunk with at least one word: hash of the bytes, text and number in the text."""

    def __init__(self, chunk: Chunk) -> None:
        self.spans = chunk.byte_spans()
        start, end, first = chunk.lines()
        word_start, word_end, _ = chunk.words()
        line = np.searchsorted(start, word_start, "right") - 1
        self.line = np.flatnonzero(np.bincount(line, minlength=len(start)))
        self.raw = self.spans.hash(start[self.line], end[self.line])
        self.text = np.searchsorted(first, self.line, "right") - 1
        self.number = self.line - first[self.text]
        self._words = word_start, word_end, np.searchsorted(self.line, line)

    def sets(self, lines: np.ndarray, rarity: Levels | None) -> _Sets:
        """The word sets of some of the lines (flags)."""
        start, end, of = self._words
        wanted = lines[of]
        return _Sets(self.spans, start[wanted], end[wanted], of[wanted], rarity)

    def with_a_word_of(self, words: Bitmap) -> np.ndarray:
        """Flags of the lines that have at least one of the words."""
        start, end, of = self._words
        return np.bincount(of[words.has(self.spans.hash(start, end))], minlength=len(self.line)) > 0


class _Sets:
    """Word sets: ``h`` sorted by line, ``begin`` and ``n`` of each line's words, its number ``line``; with ``rarity`` the first 44 bits of ``h`` and its ``level``."""

    def __init__(self, spans: Spans, start: np.ndarray, end: np.ndarray, line: np.ndarray, rarity: Levels | None) -> None:
        h = spans.hash(start, end)
        if rarity is not None and (not len(line) or line[-1] < 1 << 20):
            key = np.sort((line.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
            line, h = (key >> np.uint64(44)).astype(np.int64), key << np.uint64(20)
        else:
            h = _word(h) if rarity is not None else h
            order = np.lexsort((h, line))
            line, h = line[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
        self.h, line = h[new], line[new]
        self.level = rarity.of(self.h) if rarity is not None else np.zeros(len(self.h), np.uint8)
        self.begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else np.zeros(0, np.int64)
        self.n = np.diff(np.append(self.begin, len(line)))
        self.line = line[self.begin]


def _word(h: np.ndarray) -> np.ndarray:
    """The 44 bits of a word's hash that parts are made of: sets of them differ in no more words than the sets of words."""
    return h >> np.uint64(20) << np.uint64(20)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def _longs(n: np.ndarray) -> np.ndarray:
    """Longs of wide parity bits that sets of n words carry: none up to 96 words, then a power of two, at least two bits for three words."""
    return np.select([n <= 96, n <= 192, n <= 384], [0, 2, 4], WIDE)


def _class(n: np.ndarray) -> np.ndarray:
    """Number of the range of sizes that n is in; from 20 on it spans a tenth, so a set can match in a few of them only."""
    n = n.astype(np.int64)
    return np.where(n <= 20, n, 20 + np.floor(np.log(np.maximum(n, 20) / 20) / np.log(1.1)).astype(np.int64))


def _bitmaps(found: _Sets) -> tuple[np.ndarray, np.ndarray]:
    """64 parity bits of each set, and ``WIDE`` longs of them of which the first ``_longs(n)`` count; the 64 are the others folded."""
    mixed = mix(found.h)
    one = np.uint64(1) << (mixed >> np.uint64(58))
    wide = np.zeros((len(found.n), WIDE), np.uint64)
    if not len(one):
        return one, wide
    carries = _longs(found.n) > 0
    if carries.any():
        words = np.repeat(carries, found.n)
        bits, slot = one[words], (mixed[words] >> np.uint64(55)) & np.uint64(WIDE - 1)
        n = found.n[carries]
        begin = np.cumsum(n) - n
        for k in range(WIDE):
            wide[carries, k] = np.bitwise_xor.reduceat(np.where(slot == k, bits, np.uint64(0)), begin)
        for half in (4, 2):
            fold = _longs(found.n) <= half
            wide[fold, :half] ^= wide[fold, half : 2 * half]
    return np.bitwise_xor.reduceat(one, found.begin), wide


def _ranges(count: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each of the counts, one after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _tokens(found: _Sets, rarity: Levels) -> dict[str, np.ndarray]:
    """The rarest parts of the sets, as many as two sets that match must share one of: word (hash of the part), level (of its rarest word), at (number of the set).

    A set of n words, 2**s <= n < 2**(s + 1), is dealt into K parts by a hash of the word; sets that match differ in fewer
    parts than are sent. One that can match sets below 2**s is also dealt as these are. Parts are ordered by how rare their words are
    together, parts without a word last.
    """
    n = found.n.astype(np.int64)
    s = np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1
    also = np.flatnonzero(-(-NUMERATOR * n // DENOMINATOR) < 1 << s)
    at = np.concatenate((np.arange(len(n)), also))
    scheme = np.concatenate((s, s[also] - 1))
    both = np.concatenate((n + n * DENOMINATOR // NUMERATOR, n[also] + (1 << s[also]) - 1))
    parts = np.maximum(1, (5 << scheme) >> 3)
    sent = np.minimum(parts, both * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR) + 1)
    first = np.cumsum(parts) - parts
    which = np.repeat(found.begin[at], n[at]) + _ranges(n[at])
    mixed = mix(found.h[which] + np.uint64(0x9E3779B97F4A7C15))
    share = (mixed >> np.uint64(32)) * np.repeat(parts, n[at]).astype(np.uint64) >> np.uint64(32)
    slot = np.repeat(first, n[at]) + share.astype(np.int64)
    level, size = found.level[which], int(parts.sum())
    content, rarest = np.zeros(size, np.uint64), np.full(size, 255, np.uint8)
    np.add.at(content, slot, mix(mixed))
    np.minimum.at(rarest, slot, level)
    rare = np.bincount(slot, weights=rarity.most + 1.0 - level, minlength=size).astype(np.int64)
    rare = np.minimum(rare, (1 << 24) - 1)
    nth, part, bits = np.repeat(np.arange(len(at)), parts), _ranges(parts), int(parts.max(initial=1)).bit_length()
    taken = part < np.repeat(sent, parts)
    if bits + len(at).bit_length() <= 38:
        part = np.sort((((nth << 24) - rare) << bits) + part)[taken] & ((1 << bits) - 1)
    else:
        part = part[np.lexsort((part, -rare, nth))][taken]
    nth = np.repeat(np.arange(len(at)), sent)
    order = first[nth] + part
    part = part.astype(np.uint64) + (scheme[nth].astype(np.uint64) << np.uint64(40))
    return {"word": mix(content[order] + mix(part)), "level": rarest[order], "at": at[nth]}


def _postings(found: _Sets, tokens: dict[str, np.ndarray], frequent: int) -> dict[str, np.ndarray]:
    """Postings of the sets' parts: word, m, role (0: asks and answers, 1: answers, 2: asks), n, at (number of the set)."""
    n = found.n[tokens["at"]]
    # a frequent part's groups hold the sets of one range of sizes; a set answers in its own and asks in all that can match
    own, low, high = _class(n), _class(-(-n * NUMERATOR // DENOMINATOR)), _class(n * DENOMINATOR // NUMERATOR)
    often = tokens["level"] >= frequent
    copies = np.where(often, high - low + 2, 1)
    nth = _ranges(copies)
    n, own, low, often, word, at = (np.repeat(x, copies) for x in (n, own, low, often, tokens["word"], tokens["at"]))
    role = np.where(often, np.where(nth == 0, 1, 2), 0)
    m = np.where(role == 0, 0, np.where(role == 1, own, low + nth - 1))
    return {"word": word, "m": m, "role": role, "n": n, "at": at}


def _needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Common words that sets of n and m words need."""
    total = NUMERATOR * (n + m)
    return -(-total // (NUMERATOR + DENOMINATOR))


def _may_match(c: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of postings of one part pass the length and bitmap filters, and stand in order."""
    n, m = c["n"][x], c["n"][y]
    near = np.bitwise_count(c["bitmap"][x] ^ c["bitmap"][y]) <= n + m - 2 * _needed(n, m)
    check = np.flatnonzero(near & (c["order"][y] < c["order"][x]))
    x, y, n, m = x[check], y[check], n[check], m[check]
    need = _needed(n, m)
    left = (np.minimum(n, m) >= need) & (c["role"][y] != 2) & (c["role"][x] != 1) & c["ask"][x] & (c["raw"][x] != c["raw"][y])
    check, x, y, most_apart = check[left], x[left], y[left], (n + m - 2 * need)[left]
    ok = np.zeros(len(near), bool)
    if len(check):
        longs = np.minimum(c["longs"][x], c["longs"][y])
        apart = np.zeros(len(check), np.int64)
        for k in range(WIDE):
            live = np.flatnonzero(longs > k)
            apart[live] += np.bitwise_count(_folded(c, x[live], longs[live], k) ^ _folded(c, y[live], longs[live], k))
        ok[check] = apart <= most_apart
    return ok


def _folded(c: dict[str, np.ndarray], x: np.ndarray, longs: np.ndarray, k: int) -> np.ndarray:
    """Long ``k`` of the wide parity bits of postings, folded to so many longs: sets that may match have the same number or twice it."""
    out = c["wide"][c["wide_at"][x] + k]
    twice = np.flatnonzero(c["longs"][x] > longs)
    out[twice] ^= c["wide"][c["wide_at"][x[twice]] + k + longs[twice]]
    return out


def _pairs(table: pa.Table, wide: np.ndarray, enough: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Lines (x, y) that may match, with True, and the x that did not ask all before them (``enough`` were found), with False."""
    longs = _longs(table["n"].to_numpy())
    table = table.append_column("longs", pa.array(longs)).append_column("wide_at", pa.array(np.cumsum(longs) - longs))
    at = pc.sort_indices(table, sort_keys=[("word", "ascending"), ("m", "ascending"), ("id", "ascending"), ("line", "ascending")], null_placement="at_end")
    table = table.take(at)
    c = {name: table[name].to_numpy() for name in ("word", "m", "line", "n", "role", "raw", "bitmap", "ask", "longs", "wide_at")}
    c["bitmap"], c["wide"] = c["bitmap"].view(np.uint64), wide
    code = table["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) if len(at) else np.zeros(0, np.int32)
    new = np.ones(len(at), bool)
    new[1:] = (c["word"][1:] != c["word"][:-1]) | (c["m"][1:] != c["m"][:-1])
    step = new.copy()
    step[1:] |= (code[1:] != code[:-1]) | (c["line"][1:] != c["line"][:-1])
    c["order"] = np.cumsum(step, dtype=np.int32)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    group = np.repeat(np.arange(len(begin)), size)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    open_: list[np.ndarray] = []

    def sent(least: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        if sum(len(x) for x, _ in out) >= least:
            x, y = (c["raw"][np.concatenate(side)] for side in zip(*out))
            out.clear()
            by = np.lexsort((y, x))
            x, y = x[by], y[by]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            yield x[new], y[new], True

    small = np.flatnonzero((size[group] <= SMALL_GROUP) & (size[group] > 1)) if len(group) else np.zeros(0, np.int64)
    have = np.zeros(len(at), np.int64)
    for nth in range(SMALL_GROUP):
        small = small[(small - begin[group[small]] > nth) & (enough is None or have[small] < enough)]
        if not len(small):
            break
        y = begin[group[small]] + nth
        hit = _may_match(c, small, y)
        out.append((small[hit], y[hit]))
        have[small[hit]] += 1
        yield from sent(GATHER_PAIRS)
    if enough:
        open_.append(np.flatnonzero(have >= enough))

    for g in np.flatnonzero(size > SMALL_GROUP):
        lo, hi = begin[g], begin[g] + size[g]
        for x0 in range(lo, hi, ASKING):
            x = np.arange(x0, min(x0 + ASKING, hi))
            x = x[c["ask"][x] & (c["role"][x] != 1)]
            have = np.zeros(len(x), np.int64)
            for y0 in range(lo, min(x0 + ASKING, hi), ASKED):
                live = np.flatnonzero(have < enough) if enough else np.arange(len(x))
                if not len(live):
                    break
                y = np.arange(y0, min(y0 + ASKED, x0 + ASKING, hi))
                xs, ys = np.repeat(x[live], len(y)), np.tile(y, len(live))
                hit = _may_match(c, xs, ys)
                if enough:
                    flags = hit.reshape(len(live), len(y))
                    nth = np.cumsum(flags, axis=1) + have[live][:, None]
                    hit = (flags & (nth <= enough)).ravel()
                    have[live] += flags.sum(1)
                out.append((xs[hit], ys[hit]))
                yield from sent(GATHER_PAIRS)
            if enough:
                open_.append(x[have >= enough])
    yield from sent(1)
    if open_:
        more = np.unique(c["raw"][np.concatenate(open_)])
        yield more, more, False


def _met(own: dict[str, np.ndarray]) -> np.ndarray:
    """What postings that meet have in common: the word, and for frequent words the range of sizes."""
    return mix(own["word"] + mix(own["m"].astype(np.uint64)))


def _place_hash(raw: np.ndarray, id_hash: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(raw + mix(id_hash + mix(line.astype(np.uint64))))


def _packed(own: dict[str, np.ndarray], part: np.ndarray, ids: pa.Array, wide: np.ndarray) -> pa.RecordBatch:
    """Postings as one row of arrays for each part of the words."""
    by = np.argsort(part, kind="stable")
    used, begin = np.unique(part[by], return_index=True)
    offsets = pa.array(np.append(begin, len(by)).astype(np.int32))
    columns = [pa.array(used)]
    for name, kind in _ARRAYS.items():
        values = own[name][by]
        columns.append(pa.ListArray.from_arrays(offsets, _signed(values) if kind == "bigint" else pa.array(values.astype({"int": np.int32, "tinyint": np.int8}[kind]))))
    columns.append(pa.ListArray.from_arrays(offsets, ids.take(pa.array(by))))
    longs = _longs(own["n"])
    at, longs = (np.cumsum(longs) - longs)[by], longs[by]
    ends = np.append(0, np.cumsum(longs))[offsets.to_numpy()]
    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(wide[np.repeat(at, longs) + _ranges(longs)])))
    return pa.RecordBatch.from_arrays(columns, ["part", *_ARRAYS, "id", "wide"])


#: Arrays of postings, which travel as bytes. ``raw`` is the line's hash, ``word`` 32 bits of the part's (two that share them are only compared in vain).
_ARRAYS = {"word": np.int32, "m": np.int32, "role": np.int8, "n": np.int32, "bitmap": np.int64, "raw": np.int64, "line": np.int32}


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the values, cut at the ends (the first is 0)."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _values(column: pa.Array, kind: type) -> np.ndarray:
    """The values of all blobs of a column, one after the other."""
    column = column.cast(pa.binary())
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)


def _packed(own: dict[str, np.ndarray], part: np.ndarray, ids: pa.Array, wide: np.ndarray) -> pa.RecordBatch:
    """Postings as one row of arrays for each part of the words."""
    by = np.argsort(part, kind="stable")
    used, begin = np.unique(part[by], return_index=True)
    ends = np.append(begin, len(by))
    columns = [pa.array(used), *(_blobs(own[name][by].astype(kind, copy=False), ends) for name, kind in _ARRAYS.items())]
    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids.take(pa.array(by))))
    longs = _longs(own["n"])
    at, longs = (np.cumsum(longs) - longs)[by], longs[by]
    columns.append(_blobs(wide[np.repeat(at, longs) + _ranges(longs)], np.append(0, np.cumsum(longs))[ends]))
    return pa.RecordBatch.from_arrays(columns, ["part", *_ARRAYS, "id", "wide"])


def _unpacked(batches: list[pa.RecordBatch]) -> tuple[dict[str, np.ndarray], np.ndarray, pa.Array, np.ndarray]:
    """Postings, the part of each, their ids and wide parity bits."""
    own = {name: np.concatenate([_values(b[name], kind) for b in batches]) for name, kind in _ARRAYS.items()}
    part = np.concatenate([np.repeat(b["part"].to_numpy(), pc.list_value_length(b["id"]).to_numpy()) for b in batches])
    return own, part, pa.concat_arrays([pc.list_flatten(b["id"]) for b in batches]), np.concatenate([_values(b["wide"], np.uint64) for b in batches])


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, rounds: tuple[int | None, ...] = ROUNDS) -> DataFrame:
    """(id, key, line): the lines (from 0) of a row that go; ``key`` is xxhash64 of its text."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.xxhash64(F.col(id_col)).alias("id_hash"), F.col(text_col).cast("binary").alias("bytes"))
    spark = docs.sparkSession
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    size = text_bytes(docs, text_col)
    id_type, long = rows.schema["id"].dataType, T.LongType()

    def word_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for c in chunks(batch.column(0)):
            start, end, _ = c.words()
            yield _word(c.byte_spans().hash(start, end))

    rarity = Shared(spark, levels(rows.select("bytes"), word_hashes, min(MAX_LOG2_RARITY, log2_cells(size // BYTES_A_CELL, 1))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column(3)):
                found = _Lines(c)
                row = pa.array(found.text + c.first)
                yield pa.RecordBatch.from_arrays([_signed(found.raw), *(batch.column(k).take(row) for k in range(3)), pa.array(found.number.astype(np.int32))], place_schema.names)

    place_schema = T.StructType([T.StructField("raw", long), T.StructField("id", id_type), T.StructField("key", long), T.StructField("id_hash", long), T.StructField("line", T.IntegerType())])
    lines = materialised(rows.mapInArrow(places, place_schema))
    order = F.struct(F.col("id").isNull().alias("null"), "id", "line", "id_hash")
    first = materialised(lines.groupBy("raw").agg(F.min(order).alias("f")).select("raw", "f.id", "f.line", "f.id_hash"))

    def first_hashes(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [_place_hash(signed_hashes(batch.column(0)), signed_hashes(batch.column(1)), batch.column(2).to_numpy())]

    is_first = Shared(spark, bitmap(first.select("raw", "id_hash", "line"), first_hashes, log2_cells(first.count(), 16), 1))
    parts = max(1, size // PART_BYTES)

    def firsts(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, _Lines, _Sets, dict[str, np.ndarray]]]:
        """The first of each line (and few others), and the rarest parts of its words."""
        for c in chunks(batch.column(3)):
            found = _Lines(c)
            id_hash = signed_hashes(batch.column(2))[found.text + c.first]
            sets = found.sets(is_first.value.has(_place_hash(found.raw, id_hash, found.number)), rarity.value)
            yield c, found, sets, _tokens(sets, rarity.value)

    twice = Shared(spark, bitmap(rows, lambda batch: (tokens["word"] for *_, tokens in firsts(batch)), log2_cells(size // BYTES_A_TOKEN, 8), 2))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings of the parts that other lines may have too."""
        waiting: list[tuple[dict[str, np.ndarray], np.ndarray, pa.Array]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            if not waiting:
                return
            arrays = {name: np.concatenate([w[0][name] for w in waiting]) for name in [*_ARRAYS]}
            wide = np.concatenate([w[1] for w in waiting])
            ids = pa.concat_arrays([w[2] for w in waiting])
            waiting.clear()
            mixed = _met(arrays)
            arrays["word"] = (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)
            arrays |= {name: arrays[name].view(np.int64) for name in ("raw", "bitmap")}
            yield _packed(arrays, (mixed % np.uint64(parts)).astype(np.int32), ids, wide)
            pa.default_memory_pool().release_unused()

        gathered = 0
        for batch in batches:
            for c, found, sets, tokens in firsts(batch):
                keep = twice.value.has(tokens["word"])
                own = _postings(sets, {name: v[keep] for name, v in tokens.items()}, frequent)
                at = own.pop("at")
                line = sets.line[at]
                maps, wide = _bitmaps(sets)
                own |= {"raw": found.raw[line], "line": found.number[line], "bitmap": maps[at]}
                longs = _longs(own["n"])
                waiting.append((own, wide[np.repeat(at, longs), _ranges(longs)], batch.column(0).take(pa.array(found.text[line] + c.first))))
                gathered += len(line)
                if gathered >= GATHER:
                    yield from sent()
                    gathered = 0
        yield from sent()

    array_schema = T.StructType([T.StructField("part", T.IntegerType()), *(T.StructField(name, T.BinaryType()) for name in _ARRAYS), T.StructField("id", T.ArrayType(id_type)), T.StructField("wide", T.BinaryType())])
    postings = materialised(rows.mapInArrow(post, array_schema))

    def met(own: dict[str, np.ndarray], part: np.ndarray) -> np.ndarray:
        return mix(own["word"].astype(np.uint64) + (part.astype(np.uint64) << np.uint64(32)))

    def candidates(limit: int | None, asking: Bitmap | None = None, only: Bitmap | None = None) -> DataFrame:
        """Pairs (x, y) of lines that may match; x alone with ``all_asked`` false where it found ``limit`` and stopped. ``asking``: lines that ask; ``only``: what they post."""
        ask, words = Shared(spark, asking), Shared(spark, only)

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, part, ids, wide = _unpacked([batch])
                keep = words.value.has(met(own, part))
                wide = wide[np.repeat(keep, _longs(own["n"]))]
                yield _packed({name: v[keep] for name, v in own.items()}, part[keep], ids.filter(pa.array(keep)), wide)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, _, ids, wide = _unpacked(list(batches))
            own["ask"] = ask.value.has(own["raw"].view(np.uint64)) if ask.value is not None else np.ones(len(own["raw"]), bool)
            for x, y, all_asked in _pairs(pa.table({"id": ids} | {name: pa.array(v) for name, v in own.items()}), wide, limit):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.full(len(x), all_asked))], ["x", "y", "all_asked"])

        sent = postings if only is None else postings.mapInArrow(asked, array_schema)
        return sent.groupBy("part").applyInArrow(meet, "x bigint, y bigint, all_asked boolean").distinct()

    def asked_words(asking: Bitmap):
        """What the postings of the asking lines meet by."""
        shared = Shared(spark, asking)

        def words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            own, part, *_ = _unpacked([batch])
            yield met(own, part)[shared.value.has(own["raw"].view(np.uint64))]

        return words

    def of_lines(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The word sets of the lines in the pairs, with their first places, for x and for y."""
        wanted_lines = pairs.select(F.explode(F.array("x", "y")).alias("raw")).distinct()
        wanted = materialised(first.join(wanted_lines, "raw").select("raw", "id", "line", "id_hash"))
        cells = log2_cells(wanted.count(), 16)
        only, of_rows = (Shared(spark, bitmap(wanted.select(name), lambda batch: [signed_hashes(batch.column(0))], cells, 1)) for name in ("raw", "id_hash"))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pa.array(of_rows.value.has(signed_hashes(batch.column(0)))))
                for c in chunks(batch.column(1)):
                    found = _Lines(c)
                    one = np.zeros(len(found.raw), bool)
                    one[np.unique(found.raw, return_index=True)[1]] = True
                    own = found.sets(only.value.has(found.raw) & one, None)
                    of = pa.ListArray.from_arrays(pa.array(np.append(own.begin, len(own.h)).astype(np.int32)), _signed(own.h))
                    yield pa.RecordBatch.from_arrays([_signed(found.raw[own.line]), of], ["raw", "words"])

        table = materialised(rows.select("id_hash", "bytes").mapInArrow(sets, "raw bigint, words array<bigint>").join(wanted, "raw").dropDuplicates(["raw"]))
        at = F.struct(F.col("id").isNull().alias("null"), "id", "line").alias("at")
        return tuple(table.select(F.col("raw").alias(name), F.struct("words", at).alias(f"of_{name}")) for name in ("x", "y"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The x of the pairs that match, by their first places and word sets."""
        x, y = of_lines(pairs)
        n = F.size("of_x.words") + F.size("of_y.words")
        common = F.size(F.array_intersect("of_x.words", "of_y.words"))
        match = pairs.join(x, "x").join(y, "y").filter(F.col("of_y.at") < F.col("of_x.at"))
        return match.filter((NUMERATOR + DENOMINATOR) * common >= NUMERATOR * n).select(F.col("x").alias("raw")).distinct()

    matched, asking, only = None, None, None
    for limit in rounds:
        asked = materialised(candidates(limit, asking, only))
        found = materialised(verified(asked.filter("all_asked").select("x", "y")))
        matched = found if matched is None else matched.unionAll(found)
        rest = materialised(asked.filter("not all_asked").select(F.col("x").alias("raw")).distinct().join(matched, "raw", "left_anti"))
        waiting = rest.count()
        if not waiting:
            break
        asking = bitmap(rest, lambda batch: [signed_hashes(batch.column(0))], log2_cells(waiting, 16), 1)
        only = bitmap(postings, asked_words(asking), log2_cells(waiting, 256), 1)
    state = materialised(first.join(matched.distinct().withColumn("matched", F.lit(True)), "raw", "left").select("raw", F.col("id").alias("first_id"), F.col("line").alias("first_line"), F.coalesce("matched", F.lit(False)).alias("matched")))
    gone = ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line")))
    return lines.select("raw", "id", "key", "line").join(state, "raw").filter(F.col("matched") | gone).select("id", "key", "line")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False, **options) -> DataFrame:
    """``docs`` with the matched lines cut out of ``text_col`` and two columns more: ``n_lines`` (with a word) and ``n_removed``.

    Lines without a word stay. Rows keep their other columns; a text that loses no line is unchanged, and one that loses
    all its words is dropped if ``drop_emptied``. Null texts stay null. A null id counts as after all others; rows equal in
    id remove lines of one another only by line number. Columns ``n_lines`` and ``n_removed`` of ``docs`` are replaced. An
    empty table gives an empty result.
    """
    gone = removed_lines(docs, id_col, text_col, **options)
    # a bit for each line: rows equal in id and text give the same bits
    bits = gone.groupBy("id", "key", F.expr("line div 64").alias("block")).agg(F.expr("bit_or(shiftleft(1L, cast(line % 64 as int)))").alias("bits"))
    docs = docs.drop("n_lines", "n_removed")
    names = docs.columns
    text_key, id_, key, gone_bits, block, bit = (fresh(c, names) for c in ("__text_key", "__id", "__key", "__gone", "__block", "__bits"))
    bits = materialised(bits.groupBy(F.col("id").alias(id_), F.col("key").alias(key)).agg(F.collect_list(F.struct("block", "bits")).alias(gone_bits)))
    changed, same = split_by_key(docs.withColumn(text_key, F.xxhash64(text_col)), bits.select(key), text_key)
    joined = changed.join(bits, changed[id_col].eqNullSafe(F.col(id_)) & (changed[text_key] == F.col(key)), "left")
    joined = joined.select(*[changed[c] for c in names], F.col(f"{gone_bits}.block").alias(block), F.col(f"{gone_bits}.bits").alias(bit))
    none = F.lit(None).cast("array<bigint>")
    joined = joined.unionAll(same.select(*[same[c] for c in names], none.alias(block), none.alias(bit)))
    where = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            for text, block, bits in zip(batch.column(where), batch.column(len(names)), batch.column(len(names) + 1)):
                text = text.as_py()
                lines = text.split("\n") if text is not None else []
                removed = 0
                if block.is_valid:
                    flags = np.zeros((len(lines) // 64 + 1, 64), np.uint8)
                    flags[block.values.to_numpy()] = np.unpackbits(bits.values.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    off = flags.ravel()[: len(lines)]
                    removed = int(off.sum())
                    left = [line for line, o in zip(lines, off) if not o]
                    text = "\n".join(left)
                else:
                    left = lines
                texts.append(text)
                n_removed.append(removed)
                n_lines.append(removed + sum(1 for line in left if line.strip(" \t\n\v\f\r")))
            columns = [pa.array(texts, pa.string()) if k == where else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], [f.name for f in schema])

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    out = joined.mapInArrow(cut, schema)
    return out.filter("n_removed = 0 or n_removed < n_lines") if drop_emptied else out
