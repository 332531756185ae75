"""Two-paths drawn evenly from all of a graph, and the number of triangles estimated from those that close.

A vertex of degree d is the centre of d (d - 1) / 2 two-paths. Centres get dense ranges of that size (``with_positions``: a
running sum inside each partition of a range sort and one offset per partition), so every vertex takes part by its weight. A
draw is a number in the whole range, by a hash of seed and draw number; it finds its centre by an equi-join on bins of the
range, and the number in the centre's range names a pair of neighbours, found by their dense positions in the sorted
adjacency. No neighbour list is ever one row or one group, and only the drawn two-paths are rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.graph import symmetrize_distinct
from quarry.operators.ordering import with_global_rank
from quarry.operators.ordinals import with_positions
from quarry.session import materialize


def sample_two_paths(und: DataFrame, draws: int, seed: int = 0) -> DataFrame:
    """``(draw, center, a, b, closed, n_paths)``: ``draws`` two-paths a - center - b with a < b, drawn with replacement.

    ``und`` holds simple edges u < v; ``closed`` tells whether a - b is one of them, ``n_paths`` is the number of all
    two-paths. The same seed draws the same paths. A graph without a two-path gives no rows.
    """
    spark = und.sparkSession
    sym = symmetrize_distinct(und.select(F.col("u").alias("src"), F.col("v").alias("dst")))
    placed = with_global_rank(sym, ["src", "dst"], "place")
    per = placed.groupBy(F.col("src").alias("center")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("d")).filter("d > 1")
    weight = F.expr("d * (d - 1) div 2")
    centers = materialize(with_positions(per, "center", weight, "base", "n_paths").withColumn("weight", weight), "centers")
    n_paths = (centers.agg(F.max("n_paths")).first()[0]) or 0
    width = max(1, -(-n_paths // max(1, draws)))  # a bin holds a draw on average, so centres have at most draws + vertices bins
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    drawn = spark.range(draws if n_paths else 0).select(F.col("id").alias("draw"), (number % max(1, n_paths)).alias("at"))
    bins = centers.select("*", F.explode(F.expr(f"sequence(base div {width}, (base + weight - 1) div {width})")).alias("bin"))
    hit = drawn.withColumn("bin", F.expr(f"at div {width}")).join(bins, "bin").filter("at >= base and at < base + weight")
    # number r of the pairs (i < j) of d neighbours: j (j - 1) / 2 <= r < j (j + 1) / 2
    r = hit.select("draw", "center", "first", "n_paths", (F.col("at") - F.col("base")).alias("r"))
    near = r.withColumn("j0", F.floor((1 + F.sqrt(1 + 8 * F.col("r").cast("double"))) / 2))
    j = F.when(F.expr("j0 * (j0 - 1) div 2 > r"), F.col("j0") - 1).when(F.expr("j0 * (j0 + 1) div 2 <= r"), F.col("j0") + 1).otherwise(F.col("j0"))
    pair = near.withColumn("j", j).select("draw", "center", "n_paths", (F.col("first") + F.expr("r - j * (j - 1) div 2")).alias("ia"), (F.col("first") + F.col("j")).alias("ib"))
    ends = [placed.select(F.col("place").alias(f"i{c}"), F.col("dst").alias(c)) for c in "ab"]
    paths = pair.join(ends[0], "ia").join(ends[1], "ib").select("draw", "center", "a", "b", "n_paths")
    closing = und.select(F.col("u").alias("a"), F.col("v").alias("b"), F.lit(True).alias("found"))
    return paths.join(closing, ["a", "b"], "left").select("draw", "center", "a", "b", F.coalesce("found", F.lit(False)).alias("closed"), "n_paths")


def estimated_triangles(paths: DataFrame, z: float = 3.29) -> dict[str, float]:
    """Triangles estimated from drawn two-paths (each has three), with Wilson's interval (``z`` 3.29: 99.9 percent)."""
    n, closed, n_paths = paths.agg(F.count(F.lit(1)), F.count(F.when(F.col("closed"), 1)), F.max("n_paths")).first()
    if not n:
        return {"estimate": 0.0, "low": 0.0, "high": 0.0, "draws": 0}
    p = closed / n
    middle, reach = p + z * z / (2 * n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    low, high = (middle - reach) / (1 + z * z / n), (middle + reach) / (1 + z * z / n)
    return {"estimate": p * n_paths / 3, "low": max(0.0, low) * n_paths / 3, "high": min(1.0, high) * n_paths / 3, "draws": n}
