"""Near-duplicate documents by SimHash, linked by meet-in-the-middle ball hashing.

Two fingerprints within an odd or even distance d share a variant that lies within half of d of both. For the
maximum distance r every fingerprint therefore emits all variants within floor(r / 2) flips (its near ball), and,
where r is odd, the fingerprints of odd parity also those at one flip more (their far ball): a pair at the full odd
distance has unlike parity, so one of the two reaches the other's near ball. For r = 3 that is 65 variants, or 2081.

The shuffle of variants is factored: a variant is dealt by its block of high bits, so a fingerprint is sent once
for each block value within its ball, and the receiving task spells out the low bits of the variants. Variants that
meet in a near ball give edges to the smallest fingerprint there; a task keeps only a spanning forest of its edges,
so large groups never become all pairs. Components are then closed by a distributed join (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import connected_components, fresh, materialised
from quarry.llm.textbatch import chunks

SHINGLE_WORDS, MAX_BITS = 3, 3
#: Fingerprints that a block of the variants' high bits holds on average; the width of the block follows from their number.
BLOCK_ROWS = 20_000
#: Variants that a task spells out at once.
VARIANTS_AT_ONCE = 2_000_000


def _fingerprint(words: list[bytes], width: int) -> int:
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = ends[width - 1 :] if len(words) > width else [len(joined)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, last)), np.uint64, len(last))
    total = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65_536):
        part = h[lo : lo + 65_536]
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, carry: list[str] | None = None) -> DataFrame:
    """``id_col``, the columns ``carry`` and the signed 64-bit ``fp`` of every row. Null and wordless texts have fingerprint 0."""
    kept = [id_col, *(carry or [])]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [
                _fingerprint(c.data[a:b].tobytes().lower().split(), shingle_words)
                for c in chunks(batch.column(len(kept)))
                for a, b in zip(c.offsets[:-1], c.offsets[1:])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(np.array(fps, np.uint64).view(np.int64))], [*kept, "fp"])

    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType) for c in kept), T.StructField("fp", T.LongType())])
    return docs.select(*kept, F.col(text_col).cast("binary").alias("_bytes")).mapInArrow(compute, schema)


def _masks(bits: range, most: int) -> list[np.ndarray]:
    """For each number of flips up to ``most``: the xor masks with so many of the bits."""
    return [np.array([sum(1 << b for b in c) for c in combinations(bits, k)], np.uint64) for k in range(most + 1)]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, node) of the components of the given edges, one for each node that isn't its root."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[own]], nodes[own]


def links(fps: DataFrame, max_bits: int = MAX_BITS, block_bits: int | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of column ``fp`` that connect all pairs within ``max_bits``.

    Every edge is checked to be within ``max_bits``; a pair may be connected over a third fingerprint. The block
    width sets how finely the variants are dealt out (2**block_bits keys), not the result; it follows from the number
    of distinct fingerprints, so that a block fits a task at any size.
    """
    distinct = fps.select("fp").distinct()
    if block_bits is None:
        block_bits = min(32, max(8, (distinct.count() * 32 // BLOCK_ROWS).bit_length()))
    near_flips, odd = max_bits // 2, max_bits % 2 == 1
    far_flips = near_flips + odd
    high = _masks(range(64 - block_bits, 64), far_flips)
    low = _masks(range(64 - block_bits), far_flips)
    shift = np.uint64(64 - block_bits)

    def parity(fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp) & 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for used, masks in enumerate(high):
                own = fp if used <= near_flips else fp[parity(fp) == 1]
                spread = (own[:, None] ^ masks[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array((spread >> shift).astype(np.int32)), pa.array(np.repeat(own, len(masks)).view(np.int64)), pa.array(np.full(len(spread), used, np.int8))],
                    ["block", "fp", "used"],
                )

    def spelled(block: int, fp: np.ndarray, used: np.ndarray, flips: int, exactly: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(variant, fingerprint) in the block, within ``flips`` flips of the fingerprint, in bounded pieces."""
        for u in range(flips + 1):
            own = fp[used == u]
            for k in range(flips - u + 1):
                if exactly and u + k != flips:
                    continue
                masks = low[k]
                step = max(1, VARIANTS_AT_ONCE // len(masks))
                for lo in range(0, len(own), step):
                    part = own[lo : lo + step]
                    base = (part & np.uint64((1 << int(shift)) - 1)) | (np.uint64(block) << shift)
                    yield (base[:, None] ^ masks[None, :]).ravel(), np.repeat(part, len(masks))

    def meet(key, table):
        block = key[0].as_py()
        fp = table["fp"].to_numpy().view(np.uint64)
        used = table["used"].to_numpy()
        pieces = list(spelled(block, fp, used, near_flips, False))
        variant = np.concatenate([p[0] for p in pieces]) if pieces else np.zeros(0, np.uint64)
        source = np.concatenate([p[1] for p in pieces]) if pieces else np.zeros(0, np.uint64)
        order = np.lexsort((source, variant))
        variant, source = variant[order], source[order]
        head = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1]))) if len(variant) else np.zeros(0, np.int64)
        keys, least = variant[head], source[head]
        size = np.diff(np.concatenate((head, [len(variant)])))
        a, b = np.repeat(least, size), source
        differ = a != b
        edges = [(a[differ], b[differ])]
        if odd and len(keys):
            own = parity(fp) == 1
            for far, who in spelled(block, fp[own], used[own], far_flips, True):
                at = np.searchsorted(keys, far)
                at[at == len(keys)] = 0
                hit = keys[at] == far
                x, y = least[at[hit]], who[hit]
                near = np.bitwise_count(x ^ y) <= max_bits
                edges.append((x[near & (x != y)], y[near & (x != y)]))
        a, b = (np.concatenate([e[i] for e in edges]) for i in (0, 1))
        a, b = _forest(a, b)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.mapInArrow(deal, "block int, fp bigint, used tinyint").groupBy("block").applyInArrow(meet, "a bigint, b bigint").distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int, block_bits: int | None) -> tuple[DataFrame, DataFrame]:
    """id, ``_key`` (hash of the text) and ``fp`` of every row; ``component`` (smallest fingerprint reachable) of each linked ``fp``."""
    keyed = docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("_key"))
    fps = materialised(fingerprints(keyed, id_col, text_col, shingle_words, ["_key"]))
    return fps, connected_components(materialised(links(fps, max_bits, block_bits))).withColumnRenamed("node", "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block_bits: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the smallest id
    that can be reached. Null or wordless texts have fingerprint zero and are linked like any other. Rows with equal
    ids are each returned. A null id is kept and is never the smallest, unless all ids of its component are null: then
    the component id is null. Other columns are ignored. An empty table gives an empty result.
    """
    fps, label = _labelled(docs, id_col, text_col, shingle_words, max_bits, block_bits)
    groups = fps.groupBy("fp").agg(F.min(id_col).alias("least")).join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    root = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    of = materialised(groups.join(root, "component").select("fp", "component_id"))  # one row a fingerprint: copies are joined last, where a hot key can be split
    return fps.join(of, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block_bits: int | None = None
) -> DataFrame:
    """The documents with one of each group of near duplicates: the smallest id (nulls last), then the smallest text hash.

    All columns of ``docs`` are kept. Of rows that repeat the same id and text one stays; if they differ in other
    columns, which of them is left open.
    """
    fps, label = _labelled(docs, id_col, text_col, shingle_words, max_bits, block_bits)
    first = fps.groupBy("fp").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("_id"), F.col("_key"))).alias("b"))
    groups = first.join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    best = groups.groupBy("component").agg(F.min("b").alias("b")).select("b._id", "b._key")
    key = fresh("_key_of_text", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(text_col))
    match = keyed[id_col].eqNullSafe(best["_id"]) & (keyed[key] == best["_key"])
    return keyed.join(best, match, "left_semi").dropDuplicates([id_col, key]).drop(key)
