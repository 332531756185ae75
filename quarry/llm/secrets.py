"""Secret scans: fixed patterns, and sliding-window entropy per character class. DataFrame functions only.

Patterns are found with positions by matching ``\\G`` (gap)(pattern) over the whole text and adding up the lengths.
Candidate strings are runs of key characters with a letter. Their Shannon entropy over every window of
``WINDOW`` characters comes from incremental counts: a character that enters a window where it stood k times adds
t(k + 1) - t(k) to the sum of t(count) with t(k) = k log2 k, the one that leaves takes its share away, and a running
sum gives every window. A window that touches an allow-listed word's run of letters and digits isn't looked at; nor, in a
candidate without digits, one that touches a separator or a part with few capitals, so that paths
and dashed names are judged part by part and identifiers like ``aLongName`` left alone. The sums are whole numbers (``SCALE`` to one bit), so their order doesn't matter. Each distinct
candidate is scored once, whatever its copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.components import materialised

#: Fixed patterns and the least length of the part that counts: kind, pattern, whether that is its last group.
PATTERNS = [
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++))""", 6, True),
    ("access", r"AKIA[A-Z0-9]{16,}+", 20, False),
    ("hex", r"[0-9a-f]{24,}+", 24, False),
]
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
SCALE = 1 << 20
#: Character classes of a candidate, the first that holds all of it, and the bits a character that make a window suspect.
CLASSES = [("letters", r"^[A-Za-z+/_=-]+$", 3.7), ("hex", r"^[0-9a-fA-F]+$", 3.0), ("alnum", r"^[A-Za-z0-9]+$", 3.6), ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8)]
#: Capitals in a hundred letters up to which a part of a candidate without digits is a word or an identifier.
FEW_CAPITALS = 30
#: Known to be harmless: UUIDs, example keys, runs of the alphabet, dates and times, dashed words. Patterns from ^ to $
#: allow a whole candidate; the others allow the run of letters and digits that they stand in, not what is glued to it.
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|x{6,}|0{8,}",
    r"(?i)0123456789|abcdefghij|1234567890",
    r"^[0-9_-]+T?[0-9_-]*Z?$",
    r"^([A-Za-z]+[-_/])+[A-Za-z]*[0-9]{0,4}$",
]

_SPANS = "array<struct<start:int,end:int,text:string>>"


def _spans(text: Column, pattern: str, least: int = 0, last_group: bool = False) -> Column:
    """(start, end, text) of the leftmost non-overlapping matches, in characters; dropped if the counting part is shorter than ``least``."""
    whole = F.lit(rf"\G((?s:.*?))({pattern})")
    gap, match = (F.regexp_extract_all(text, whole, F.lit(k)) for k in (1, 2))
    part = F.regexp_extract_all(text, whole, F.lit(3)) if last_group else match
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        own = F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("text")))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= least, F.concat(acc["out"], own)).otherwise(acc["out"]).alias("out"))

    zipped = F.arrays_zip(gap.alias("gap"), match.alias("match"), part.alias("part"))
    return F.when(text.rlike(pattern), F.aggregate(zipped, empty, step)["out"]).otherwise(F.array().cast(_SPANS))


def _suspect(strings: DataFrame, window: int) -> DataFrame:
    """(text, runs): for each distinct candidate of column ``text`` the maximal stretches covered by windows of high entropy."""
    t = F.expr("array(" + ", ".join(f"{round(k * math.log2(k) * SCALE) if k else 0}L" for k in range(window + 1)) + ")")
    allowed, words = (F.lit("|".join(f"(?:{a})" for a in ALLOWED if a.startswith("^") == whole)) for whole in (True, False))
    pieces = F.regexp_extract_all("text", F.lit("[A-Za-z0-9]++|[^A-Za-z0-9]++"), F.lit(0))
    no_digits = F.rlike("text", F.lit(CLASSES[0][1]))

    def is_harmless(piece: Column) -> Column:
        capitals = F.length(F.regexp_replace(piece, "[^A-Z]", ""))
        return F.rlike(piece, words) | (no_digits & (100 * capitals <= FEW_CAPITALS * F.length(piece)))

    harmless = F.flatten(F.transform(pieces, lambda p: F.array_repeat(is_harmless(p).cast("int"), F.length(p))))
    harmless = F.when(F.rlike("text", words) | no_digits, harmless).otherwise(F.array_repeat(F.lit(0), F.length("text")))
    limit = F.coalesce(*[F.when(F.col("text").rlike(p), F.lit(bits)) for _, p, bits in CLASSES])
    one = strings.distinct().filter(~F.rlike("text", allowed) & (F.length("text") >= window)).withColumn("limit", limit)
    each = F.arrays_zip(F.split("text", "").alias("char"), harmless.alias("harmless"))
    chars = one.select(F.xxhash64("text").alias("h"), "limit", F.posexplode(each).alias("at", "c")).select("h", "limit", "at", "c.char", "c.harmless").filter("char <> ''")
    same = Window.partitionBy("h", "char").orderBy("at")
    counted = (
        chars.withColumn("before", F.count("*").over(same.rangeBetween(1 - window, -1)))
        .withColumn("after", F.count("*").over(same.rangeBetween(1, window - 1)))
    )
    # what a character adds when it enters the window that ends at it, and takes away when the window has moved past it
    gain = F.element_at(t, (F.col("before") + 2).cast("int")) - F.element_at(t, (F.col("before") + 1).cast("int"))
    loss = F.element_at(t, (F.col("after") + 2).cast("int")) - F.element_at(t, (F.col("after") + 1).cast("int"))
    order = Window.partitionBy("h").orderBy("at")
    summed = (
        counted.select("h", "limit", "at", "harmless", gain.alias("gain"), loss.alias("loss"))
        .withColumn("left", F.coalesce(F.lag("loss", window).over(order), F.lit(0)))
        .withColumn("harmless", F.max("harmless").over(order.rowsBetween(1 - window, 0)))
        .withColumn("t", F.sum(F.col("gain") - F.col("left")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    entropy = F.lit(math.log2(window)) - F.col("t") / (window * SCALE)
    high = summed.filter((F.col("at") >= window - 1) & (F.col("harmless") == 0) & (entropy >= F.col("limit"))).select("h", "at")
    new = (F.col("at") - F.lag("at").over(order) > window) | F.lag("at").over(order).isNull()
    stretch = high.withColumn("new", new.cast("int")).withColumn("n", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = stretch.groupBy("h", "n").agg((F.min("at") - window + 1).alias("lo"), (F.max("at") + 1).alias("hi"))
    return runs.groupBy("h").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def _of_kind(nth: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(nth).alias("nth"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, n_entropy, spans.

    Spans are kind:start:end in characters, by start and then kind (assign, access, hex, entropy). Entropy spans that
    lie within a span of a pattern, candidates on the allow-list and windows that touch an allow-listed word are left out. Null and empty texts have no span.
    Repeated rows are each scanned and null ids kept. Other columns are ignored. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    base = F.concat(*[F.transform(_spans(F.col("text"), p, least, group), _of_kind(k, kind)) for k, (kind, p, least, group) in enumerate(PATTERNS)])
    found = materialised(rows.select("id", "key", base.alias("base"), _spans(F.col("text"), CANDIDATE).alias("candidates")))
    each = found.select("id", "key", "base", F.explode("candidates").alias("c")).select("id", "key", "base", F.col("c.start").alias("from"), F.col("c.text").alias("text"))
    suspect = materialised(_suspect(each.select("text"), window))
    spans = (
        each.withColumn("h", F.xxhash64("text")).join(suspect, "h")
        .select("id", "key", "base", "from", F.explode("runs").alias("r"))
        .select("id", "key", "base", (F.col("from") + F.col("r.lo")).cast("int").alias("start"), (F.col("from") + F.col("r.hi")).cast("int").alias("end"))
        .filter(~F.exists("base", lambda b: (b["start"] <= F.col("start")) & (F.col("end") <= b["end"])))
        .groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
        .agg(F.collect_set(F.struct("start", F.lit(len(PATTERNS)).alias("nth"), "end", F.lit("entropy").alias("kind"))).alias("more"))
    )
    joined = found.join(spans, found["id"].eqNullSafe(F.col("_id")) & (found["key"] == F.col("_key")), "left")
    count = [F.size(F.filter("base", _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in PATTERNS]
    return joined.select(
        F.col("id").alias(id_col), *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.when(F.col("more").isNull(), 0).otherwise(F.size("more")).cast("long").alias("n_entropy"),
        _joined(F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))).alias("spans"),
    )
