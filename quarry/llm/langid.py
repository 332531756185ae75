"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of characters that are not letters becomes one blank; all n-grams of 1 to 3
characters (but blank ones) are hashed into buckets. Training sums bucket counts per language over all training
documents (a grouped sum). The matrix of log probabilities has ``buckets x languages`` cells, at most
``MATRIX_CELLS``: more languages get fewer buckets, and more than ``MAX_LANGUAGES`` raise an error. It is broadcast,
and each task scores a group of whole texts at once: their n-grams are one sparse matrix (text, bucket, count) whose
products with the rows of the log probabilities are summed per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.sketch import Shared
from quarry.llm.textbatch import mix

ORDERS = (1, 2, 3)
MATRIX_CELLS = 1 << 22
MAX_LANGUAGES = 4096
SMOOTHING = 0.1
UNKNOWN = "und"
_PIECE_CHARS = 250_000
#: Products that a task holds at once when it scores.
SCORE_CELLS = 1 << 21

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts in groups of about ``_PIECE_CHARS`` characters, with the number of the first of each."""
    group: list[str | None] = []
    first = chars = 0
    for k, text in enumerate(texts):
        group.append(text.as_py())
        chars += len(group[-1] or "")
        if chars >= _PIECE_CHARS:
            yield first, group
            group, first, chars = [], k + 1, 0
    if group:
        yield first, group


def _sparse(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse matrix of a group of texts: row (text), bucket and count of its n-grams, by row and bucket.

    A text without a letter has none; n-grams never span two texts.
    """
    parts = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    points = np.concatenate(parts)
    row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    letter = _is_letter()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])  # a run of other characters leaves one blank
    points, row = np.where(letter, points, 32)[keep].astype(np.uint64), row[keep]
    cells, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(points), _PIECE_CHARS):
        part, own, found = points[lo : lo + _PIECE_CHARS + ORDERS[-1] - 1], row[lo : lo + _PIECE_CHARS + ORDERS[-1] - 1], []
        for n in ORDERS:
            m = min(_PIECE_CHARS, len(part) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + part[k : k + m]
            whole = own[:m] == own[n - 1 : n - 1 + m]
            if n == 1:
                whole &= part[:m] != 32
            found.append(own[:m][whole] * buckets + (mix(h[whole]) >> np.uint64(40)).astype(np.int64) % buckets)
        cell, count = np.unique(np.concatenate(found), return_counts=True)
        cells.append(cell)
        counts.append(count)
    cell, inverse = np.unique(np.concatenate(cells), return_inverse=True)
    count = np.zeros(len(cell), np.int64)
    np.add.at(count, inverse, np.concatenate(counts))
    return cell // buckets, cell % buckets, count


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log, per language
    log_p: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best language (-1: none) and its posterior probability, for a group of texts at once."""
        best, p = np.full(len(texts), -1), np.zeros(len(texts))
        if not self.languages:
            return best, p
        row, at, n = _sparse(texts, len(self.log_p))
        score = np.tile(self.prior, (len(texts), 1))
        step, lo = max(1, SCORE_CELLS // len(self.languages)), 0
        while lo < len(row):
            hi = min(lo + step, len(row))
            if hi < len(row) and (start := int(np.searchsorted(row, row[hi]))) > lo:
                hi = start  # whole texts, where they fit, so that a text's sum doesn't depend on its neighbours
            begin = np.flatnonzero(np.diff(row[lo:hi], prepend=-1))
            score[row[lo:hi][begin]] += np.add.reduceat(n[lo:hi, None] * self.log_p[at[lo:hi]], begin, axis=0)
            lo = hi
        known = np.unique(row)
        likely = np.exp(score[known] - score[known].max(1, keepdims=True))
        best[known] = likely.argmax(1)
        p[known] = likely.max(1) / likely.sum(1)
        return best, p


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows with a language and a letter; ties in probability later go to the first language by name."""
    docs = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    languages = sorted(r[0] for r in docs.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    code = {lang: i for i, lang in enumerate(languages)}
    buckets = 1 << min(16, (MATRIX_CELLS // max(1, len(languages))).bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, total in totals.items():
                at = np.flatnonzero(total)
                values = [[lang] * (len(at) + 1), np.append(at, -1).astype(np.int32), np.append(total[at], n_docs[lang])]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["lang", "bucket", "n"])
            totals.clear()
            n_docs.clear()

        for batch in batches:
            langs = np.array([code[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, texts in _batches(batch.column(1)):
                row, at, n = _sparse(texts, buckets)
                lang_of = langs[first : first + len(texts)]
                for k in np.unique(lang_of[row]):
                    own, lang = lang_of[row] == k, languages[k]
                    if lang not in totals and len(totals) >= 64:
                        yield from flush()
                    np.add.at(totals.setdefault(lang, np.zeros(buckets, np.int64)), at[own], n[own])
                    n_docs[lang] = n_docs.get(lang, 0) + len(np.unique(row[own]))
        yield from flush()

    # a row a language, at most buckets x languages cells, which MATRIX_CELLS bounds
    summed = docs.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).toArrow().combine_chunks()
    counts, docs_of = np.zeros((buckets, len(languages))), np.zeros(len(languages))
    for lang, cells in zip(rows["lang"].to_pylist(), rows["cells"]):
        bucket, n = (x.to_numpy() for x in cells.values.flatten())
        own = bucket >= 0
        counts[bucket[own], code[lang]] = n[own]
        docs_of[code[lang]] = n[~own].sum()
    used = np.flatnonzero(docs_of)
    counts, docs_of = counts[:, used] + SMOOTHING, docs_of[used]
    return Model([languages[i] for i in used], np.log(docs_of / max(1, docs_of.sum())), np.log(counts / counts.sum(0)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all, if not given), ``lang_pred`` and ``score`` (the posterior probability)."""
    names = docs.columns if carry is None else carry
    shared = Shared(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(texts) for _, texts in _batches(batch.column(len(names)))]
            best, p = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in (0, 1))
            labels = [known.languages[k] if k >= 0 else UNKNOWN for k in best]
            arrays = [pa.array(labels, pa.string()), pa.array(p, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *arrays], [*names, "lang_pred", "score"])

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*[docs[c] for c in names], docs[text_col].alias("__text")).mapInArrow(score, schema)


def held_out(id_col: str) -> Column:
    """The third of the documents that is never learnt from: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    Learns from the rows that are not held out and have a language. Null texts and texts without a letter give
    ``und`` with score 0; so does everything when there is nothing to learn from. Repeated rows count as often as they
    occur. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("held_out"))
    model = train(rows.filter(~F.col("held_out")))
    return predict(rows.select("id", "held_out", "text"), model, "text", ["id", "held_out"]).withColumnRenamed("id", id_col)
