"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document gives integer rates (parts per thousand). For every (language, source) a sketch keeps, per rate, how
many documents fall into each of a fixed set of buckets: exact below 256, above that the eight highest bits
(relative error under 1/128). Sketches merge by adding counts, so they don't depend on the order of the data and a
recomputed task gives the same thresholds. The threshold of a rate is an outer fence of its group,
``q75 + FENCE * max(q75 - q25, SLACK)`` (for word length also the one below); a group with fewer than ``MIN_ROWS``
documents takes the merged sketch of its language, and failing that of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import fresh, materialised
from quarry.llm.textbatch import IS_WORD, Chunk, Spans, chunks, inside, owner

MIN_WORDS = 50
FENCE = 3
MIN_ROWS = 100
#: Rates (parts per thousand): numerator, denominator, smallest spread, whether too little is bad as well.
RATES = {
    "word_length": ("word_chars", "n_words", 400, True),
    "symbols": ("n_symbols", "word_chars", 10, False),
    "capitals": ("n_capitals", "word_chars", 30, False),
    "repeats": ("n_repeat_words", "n_words", 120, False),
    "lines": ("n_dup_lines", "n_lines", 150, False),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
#: Bytes of thresholds up to which they are broadcast; beyond, the join is a shuffle.
BROADCAST_BYTES = 8 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SCALAR = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(of: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: an equal value stands earlier in the same text; an equal value stands anywhere else in it."""
    order = np.lexsort((value, of))
    same = (of[order][1:] == of[order][:-1]) & (value[order][1:] == value[order][:-1])
    later, any_other = np.zeros(len(of), bool), np.zeros(len(of), bool)
    later[order[1:]] = same
    any_other[order[1:]] |= same
    any_other[order[:-1]] |= same
    return later, any_other


def _counts(c: Chunk) -> list[np.ndarray]:
    spans = c.byte_spans()
    start, end, first = c.words()
    n_words = np.diff(first)
    word_chars = _per_text(_SCALAR[c.data] & IS_WORD[c.data], c.offsets)
    window = Spans(spans.hash(start, end)).windows(3)
    ok = np.flatnonzero(inside(first, 3))
    repeated = np.zeros(len(start), bool)
    if len(ok):
        again = ok[_seen_before(owner(first)[ok], window[ok])[1]]
        for k in range(3):
            repeated[again + k] = True
    line_start, line_end, line_first = c.lines()
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_of = owner(line_first)[has_word]
    dup = _seen_before(line_of, spans.hash(line_start[has_word], line_end[has_word]))[0]
    n = len(c.rows)
    return [
        n_words, word_chars, _per_text(_SYMBOL[c.data], c.offsets), np.bincount(line_of[dup], minlength=n),
        _per_text(repeated, first), np.bincount(line_of, minlength=n), _per_text(_CAPITAL[c.data], c.offsets),
    ]


def with_counts(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, into: str = "quality") -> DataFrame:
    """The columns ``carry`` (all, if not given) and struct ``into`` of the exact counts of each whole text.

    Lines are compared as whole byte strings and three-word windows as word sequences, both by 64-bit hashes within
    one text. A null text counts as one without words.
    """
    names = docs.columns if carry is None else carry
    text = names.index(text_col) if text_col in names else len(names)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_counts(c) for c in chunks(batch.column(text))]
            arrays = [pa.array(np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.StructArray.from_arrays(arrays, COUNTS)], [*names, into])

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(into, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])
    return docs.select(*[docs[c] for c in names], *([docs[text_col]] if text == len(names) else [])).mapInArrow(compute, schema)


def base_failed(q: str = "quality") -> Column:
    return (F.col(f"{q}.n_words") < MIN_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > 50 * F.col(f"{q}.n_words"))


def _rate(name: str, q: str) -> Column:
    part, whole, _, _ = RATES[name]
    return F.expr(f"({q}.{part} * 1000) div greatest({q}.{whole}, 1)")


def _bucket(value: Column) -> Column:
    """Lower edge of the sketch bucket of a value of 0 or more."""
    shift = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame, lang_col: str = "lang", source_col: str = "source", q: str = "quality") -> DataFrame:
    """(lang, source, rate, edge, n): the sketch of every group, over the documents with at least one word."""
    rates = F.array(*[F.struct(F.lit(r).alias("rate"), _bucket(_rate(r, q)).alias("edge")) for r in RATES])
    return (
        counted.filter(F.col(f"{q}.n_words") > 0)
        .select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.explode(rates).alias("r"))
        .groupBy("lang", "source", "r.rate", "r.edge").agg(F.count("*").alias("n"))
    )


def thresholds(sketch: DataFrame, fence: int = FENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, low_<rate>, high_<rate> ...) of every group of the sketch; merges sketches for small groups."""
    levels = {"group": ["lang", "source"], "language": ["lang"], "all": []}
    quartiles = {}
    for level, keys in levels.items():
        merged = sketch.groupBy(*keys, "rate", "edge").agg(F.sum("n").alias("n"))
        per = Window.partitionBy(*keys, "rate")
        ranked = merged.withColumn("upto", F.sum("n").over(per.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(per))
        quartiles[level] = ranked.groupBy(*keys, "rate").agg(
            F.max("total").alias("total"),
            F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("edge"))).alias("q25"),
            F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("edge"))).alias("q75"),
        ).select(*keys, "rate", F.struct("total", "q25", "q75").alias(level))
    best = (
        quartiles["group"]
        .join(quartiles["language"].withColumnRenamed("lang", "_lang").withColumnRenamed("rate", "_rate"), F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("rate") == F.col("_rate")))
        .join(quartiles["all"].withColumnRenamed("rate", "__rate"), F.col("rate") == F.col("__rate"))
        .withColumn("use", F.when(F.col("group.total") >= min_rows, F.col("group")).when(F.col("language.total") >= min_rows, F.col("language")).otherwise(F.col("all")))
    )
    slack = F.create_map(*[x for r, (_, _, s, _) in RATES.items() for x in (F.lit(r), F.lit(s))])
    spread = fence * F.greatest(F.col("use.q75") - F.col("use.q25"), slack[F.col("rate")])
    fenced = best.select("lang", "source", "rate", (F.col("use.q25") - spread).alias("low"), (F.col("use.q75") + spread).alias("high"))
    pick = [F.max(F.when(F.col("rate") == r, F.col(side))).alias(f"{side}_{r}") for r in RATES for side in ("low", "high")]
    return fenced.groupBy("lang", "source").agg(*pick)


def judged(counted: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source", q: str = "quality", into: str = "verdict") -> DataFrame:
    """``counted`` plus struct ``into`` (base_failed, kept, failed: the rates outside their fences)."""
    limits = materialised(limits)
    size = limits.agg(F.sum(F.coalesce(F.octet_length("lang"), F.lit(0)) + F.coalesce(F.octet_length("source"), F.lit(0)) + 200)).first()[0] or 0
    own = fresh("limits", [*counted.columns, into])
    limits = limits.select(F.struct("*").alias(own))
    if size <= BROADCAST_BYTES:
        limits = F.broadcast(limits)
    outside = []
    for r, (_, _, _, both) in RATES.items():
        value = _rate(r, q)
        bad = value > F.col(f"{own}.high_{r}")
        outside.append(F.when(bad | (value < F.col(f"{own}.low_{r}")) if both else bad, F.lit(r)))
    match = counted[lang_col].eqNullSafe(F.col(f"{own}.lang")) & counted[source_col].eqNullSafe(F.col(f"{own}.source"))
    failed = F.array_compact(F.array(*outside))
    return counted.join(limits, match, "left").select(
        *[counted[c] for c in counted.columns],
        F.struct(base_failed(q).alias("base_failed"), (~base_failed(q) & (F.size(failed) == 0)).alias("kept"), failed.alias("failed")).alias(into),
    )


def rate_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, the exact counts, base_failed, kept, failed_rules.

    Null and empty texts have no words and fail; a null language or source is a group of its own. Repeated rows are
    each rated. Other columns are ignored. An empty table gives an empty result.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    counted = materialised(with_counts(plain, "text", ["id", "lang", "source"]))
    out = judged(counted, thresholds(sketches(counted)))
    return out.select(F.col("id").alias(id_col), *[f"quality.{c}" for c in COUNTS[:5]], "verdict.base_failed", "verdict.kept", F.array_join("verdict.failed", ",").alias("failed_rules"))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that pass, with their columns as they are; see ``rate_documents`` for nulls and empty tables.

    A first pass gathers the sketches, a second one counts again and filters, so no text is shuffled.
    """
    narrow = docs.select(lang_col, source_col, text_col)
    limits = thresholds(sketches(with_counts(narrow, text_col, [lang_col, source_col]), lang_col, source_col))
    counts, verdict = fresh("__quality", docs.columns), fresh("__verdict", docs.columns)
    out = judged(with_counts(docs, text_col, into=counts), limits, lang_col, source_col, counts, verdict)
    return out.filter(F.col(f"{verdict}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
