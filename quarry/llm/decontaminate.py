"""Benchmark decontamination by item-sized windows and their SimHash. DataFrame functions only.

Words are lower-cased runs of letters and digits; a shingle is five of them (an item with fewer is one shingle). A
passage matches an item if a window of as many words has a weighted-shingle similarity of at least 0.8, that is the
sum of the smaller over the sum of the larger count of each shingle (for a text shorter than the item, its whole).

1. Texts that share no shingle with any item are dropped where they are read. A window that matches an item shares a
   shingle with it, and moved to the first one it shares (or back to the text's end) it matches at least as well, so only windows that
   start there are looked at.
2. Windows and items of one size are joined on ``radius + 1`` blocks of the bits of their 64-bit SimHashes: fingerprints
   within the radius agree in one block at least, so every such pair is found.
3. What remains is verified by the exact similarity.

The default ``RADIUS`` is above the largest distance measured on passages near the least similarity. ``radius=None`` instead
compares each window with the items that hold the shingle it starts with, whatever the distance of the fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import fresh, materialised

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Of 2,352 made passages of similarity 0.8 to 0.85 (items of 13, 50 and 100 words) none was more than 22 bits apart.
RADIUS = 24
#: Words of all items up to which their shingles are a constant of the filter and item tables are broadcast; beyond, both
#: are joins that Spark shuffles.
BROADCAST_WORDS = 50_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(width: int) -> Column:
    """Hashes of the shingles of column ``words``, in order; none if there are fewer words."""
    parts = ", ".join(f"words[i + {k}]" for k in range(width))
    return F.expr(f"if(size(words) < {width}, cast(array() as array<bigint>), transform(sequence(0, size(words) - {width}), i -> xxhash64({parts})))")


def _fingerprint(shingles: str) -> str:
    """SQL for the SimHash of an array of hashes: two 32-bit lanes of each of 32 sums count the bits."""
    lanes = f"aggregate({shingles}, array_repeat(0L, 32), (acc, h) -> transform(acc, (a, k) -> a + (shiftrightunsigned(h, k) & 4294967297L)))"
    bits = f"transform({lanes}, a -> named_struct('lo', 2 * (a & 4294967295L) > size({shingles}), 'hi', 2 * shiftrightunsigned(a, 32) > size({shingles})))"
    return (
        f"aggregate(transform({bits}, (b, k) -> if(b.lo, shiftleft(1L, k), 0L) | if(b.hi, shiftleft(1L, k + 32), 0L)), 0L, (f, x) -> f | x)"
    )


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 1 blocks of the 64."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def _block_values(fp: str, radius: int) -> Column:
    values = ", ".join(f"named_struct('block', {k}, 'value', shiftrightunsigned({fp}, {a}) & {(1 << n) - 1}L)" for k, (a, n) in enumerate(_blocks(radius)))
    return F.explode(F.expr(f"array({values})")).alias("b")


def _similarity() -> Column:
    """Weighted Jaccard of the arrays ``shingles`` and ``item_shingles``, ``both`` being their different common elements."""
    common = F.expr(
        "if(size(array_distinct(shingles)) = size(shingles) or size(array_distinct(item_shingles)) = size(item_shingles), size(both), "
        "aggregate(both, 0, (s, x) -> s + least(size(filter(shingles, y -> y = x)), size(filter(item_shingles, y -> y = x)))))"
    )
    return common / (F.size("shingles") + F.size("item_shingles") - common)


def _sharing(shingled: DataFrame, wanted: DataFrame, small: bool) -> DataFrame:
    """The rows of which some hash in ``all`` is in ``wanted.h``."""
    if small:
        hashes = [r["h"] for r in wanted.collect()]  # at most BROADCAST_WORDS
        listed = ", ".join(f"{h}L" if h > -(2**63) else "cast('-9223372036854775808' as bigint)" for h in hashes)
        return shingled.filter(F.expr(f"exists(all, h -> h in ({listed}))") if hashes else F.lit(False))
    hit = shingled.select("id", "key", F.explode("all").alias("h")).join(wanted, "h", "left_semi").select(F.col("id").alias("_id"), F.col("key").alias("_key")).distinct()
    return shingled.join(hit, shingled["id"].eqNullSafe(F.col("_id")) & (shingled["key"] == F.col("_key")), "left_semi")


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY, radius: int | None = RADIUS,
) -> DataFrame:
    """(id, key, item, similarity, distance, start, n_words): the best window of every (document, item) that matches.

    Only those whose fingerprints are within the ``radius``, if there is one. ``key`` is xxhash64 of the text, ``start`` the window's first word. Null, empty and wordless texts and items match
    nothing. Rows equal in id and text count once, null ids are kept, and of equally good windows the first is given. Other
    columns are ignored. An empty table on either side gives an empty result.
    """
    item = materialised(
        items.select(F.col(item_col).alias("item"), _words(F.col(item_text_col)).alias("words")).filter(F.size("words") > 0).select("item", "words", F.size("words").alias("n"))
    )
    sizes = item.agg(F.sum("n"), F.collect_set(F.least("n", F.lit(shingle_words)))).first()
    small = (sizes[0] or 0) <= BROADCAST_WORDS
    widths = sorted(sizes[1]) or [shingle_words]  # at most shingle_words of them

    def maybe(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).filter("text is not null")
    found = []
    for width in widths:
        own = item.filter(F.least("n", F.lit(shingle_words)) == width).withColumn("item_shingles", _shingles(width))
        own = own.select("item", "n", "item_shingles")
        wanted = own.select("n", F.explode("item_shingles").alias("h")).distinct()

        # a generator, so that no filter below makes Spark split the text again for each shingle
        tokens = rows.select("id", "key", F.explode(F.array(_words(F.col("text")))).alias("words"))
        shingled = tokens.select("id", "key", F.size("words").alias("n_words"), _shingles(width).alias("all"))
        sharing = materialised(_sharing(shingled, wanted.select("h").distinct(), small))
        hits = sharing.select("id", "key", "n_words", F.posexplode("all").alias("at", "h")).join(maybe(wanted), "h")
        starts = hits.select("id", "key", "n", F.greatest(F.least("at", F.col("n_words") - F.col("n")), F.lit(0)).alias("start"))
        starts = starts.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_set(F.struct("n", "start")).alias("starts"))
        texts = sharing.dropDuplicates(["id", "key"])
        texts = texts.join(starts, texts["id"].eqNullSafe(F.col("_id")) & (texts["key"] == F.col("_key")))
        windows = (
            texts.select("id", "key", "n_words", F.explode(F.expr(f"transform(starts, s -> named_struct('n', s.n, 'start', s.start, 'shingles', slice(all, s.start + 1, s.n - {width - 1})))")).alias("w"))
            .select("id", "key", "n_words", "w.*")
        )
        if radius is None:
            number = F.xxhash64("item", "n", "item_shingles").alias("number")  # items of one number are all looked at
            theirs = own.select("*", number)
            last = F.expr("start >= n_words - n")
            mine = windows.select("*", F.explode(F.when(last, F.array_distinct("shingles")).otherwise(F.slice("shingles", 1, 1))).alias("h"))
            near = mine.join(maybe(theirs.select("n", "number", F.explode("item_shingles").alias("h")).distinct()), ["n", "h"])
            near = near.join(maybe(theirs.drop("n").dropDuplicates(["item", "item_shingles"])), "number")
        else:
            mine = windows.withColumn("fp", F.expr(_fingerprint("shingles"))).select("*", _block_values("fp", radius)).select("id", "key", "n", "start", "shingles", "fp", "b.block", "b.value")
            theirs = own.withColumn("item_fp", F.expr(_fingerprint("item_shingles"))).select("*", _block_values("item_fp", radius)).select("item", "n", "item_shingles", "item_fp", "b.block", "b.value")
            x = "(fp ^ item_fp)"
            earlier = " and ".join(f"(block <= {k} or shiftrightunsigned({x}, {a}) & {(1 << n) - 1}L <> 0)" for k, (a, n) in enumerate(_blocks(radius)))
            near = mine.join(maybe(theirs), ["n", "block", "value"]).filter(f"bit_count({x}) <= {radius}").filter(earlier)  # the first equal block stands for the pair
        # a generator, so that the filters below don't make it again
        near = near.withColumn("both", F.explode(F.array(F.array_intersect("shingles", "item_shingles"))))
        if radius is None:
            near = near.filter("h = both[0]")  # the first in common stands for the pair
        near = near.withColumn("similarity", _similarity()).filter(F.col("similarity") >= similarity)
        distance = F.expr(f"bit_count({_fingerprint('shingles')} ^ {_fingerprint('item_shingles')})").alias("distance")
        found.append(
            near.select("id", "key", "item", "similarity", distance, "start", F.col("n").alias("n_words"))
        )
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    best = every.groupBy("id", "key", "item").agg(F.max(F.struct("similarity", -F.col("start"), "distance", "n_words")).alias("b"))
    return best.select("id", "key", "item", "b.similarity", "b.distance", (-F.col("b.col2")).alias("start"), "b.n_words")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, item_id, similarity, distance, start, n_words) of every document that holds a passage of an item; see ``find``."""
    item_col = options.get("item_col", "item_id")
    return find(docs, items, id_col, text_col, **options).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "similarity", "distance", "start", "n_words")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no passage of any item, with their columns as they are.

    Null, empty and wordless texts stay; repeated rows stay or go together. Columns may have any names. An empty
    table gives an empty result, and no items remove nothing.
    """
    id_, key = fresh("_id", docs.columns), fresh("_key", docs.columns)
    bad = materialised(find(docs, items, id_col, text_col, **options).select(F.col("id").alias(id_), F.col("key").alias(key)).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(F.col(id_)) & (F.xxhash64(docs[text_col]) == F.col(key)), "left_anti")
