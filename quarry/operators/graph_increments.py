"""Triangles of edges that arrive in batches: only triangles with a new edge are looked for, old parts are not rewritten.

Every batch leaves its new edges and their degrees as parts of a kept table (``sinks.manifest``). For a new edge (u, v), the
neighbours of the end of lower degree go to the other end: as many as the smaller degree, sqrt(2m) on average over the edges
of any graph. Where the other end has ``LIST`` neighbours at most, both ends' lists meet in one row; to a hub every
neighbour w goes as a row, and the third side is looked up by an equi-join on both its ends. A triangle with c new edges is
found by each of them, so the triangles found are counted by c and divided by it.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.graph import degrees, simple_undirected
from quarry.session import materialize
from quarry.sinks import manifest


LIST = 1024


def _all(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def new_triangles(old: DataFrame, new: DataFrame, degree: DataFrame, longest: int = LIST) -> int:
    """Triangles of ``old`` and ``new`` (disjoint simple edges u < v) that hold a new edge; ``degree`` is that in both."""
    every = old.select("u", "v", F.lit(0).alias("fresh")).unionAll(new.select("u", "v", F.lit(1).alias("fresh")))
    du, dv = (degree.select(F.col("vertex").alias(c), F.col("degree").alias(f"d{c}")) for c in "uv")
    first = F.struct("du", "u") <= F.struct("dv", "v")
    edges = new.join(du, "u").join(dv, "v").select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("low"), F.when(first, F.col("v")).otherwise(F.col("u")).alias("other"), F.greatest("du", "dv").alias("d"))
    edges = materialize(edges, "directed-edges")
    ends = F.array(F.struct(F.col("u").alias("low"), F.col("v").alias("w")), F.struct(F.col("v").alias("low"), F.col("u").alias("w")))
    around = every.select(F.explode(ends).alias("e"), F.col("fresh").alias("near")).select("e.low", "e.w", "near")
    found = Counter()
    for r in _by_lists(edges.filter(F.col("d") <= longest), around, degree.filter(F.col("degree") > longest)).collect():  # three rows
        found[r["c"]] += r["n"]
    to_hubs = edges.filter(F.col("d") > longest)
    if not to_hubs.isEmpty():  # the edges are written already
        thirds = to_hubs.join(around, "low").filter("w <> other").select(F.least("w", "other").alias("u"), F.greatest("w", "other").alias("v"), "near")
        for r in thirds.join(every, ["u", "v"]).groupBy((1 + F.col("near") + F.col("fresh")).alias("c")).agg(F.count("*").alias("n")).collect():  # three rows
            found[r["c"]] += r["n"]
    return sum(n // c for c, n in found.items())


def _by_lists(edges: DataFrame, around: DataFrame, hubs: DataFrame) -> DataFrame:
    """``(c, n)``: triangles of the ``edges`` (low, other) whose ends are not ``hubs``, by their number of new edges.

    There are fewer hubs than edges by half the length of a list; they are broadcast.
    """
    known = [F.collect_list(F.when(F.col("near") == k, F.col("w"))).alias(name) for k, name in enumerate(["old", "new"])]
    short = around.join(F.broadcast(hubs.select(F.col("vertex").alias("low"))), "low", "left_anti")
    lists = materialize(short.groupBy("low").agg(*known), "neighbours")
    theirs = lists.select(F.col("low").alias("other"), F.col("old").alias("o_old"), F.col("new").alias("o_new"))
    met = edges.select("low", "other").join(lists, "low").join(theirs, "other")
    met = met.select("new", "o_new", F.array_intersect(F.concat("o_old", "o_new"), F.concat("old", "new")).alias("both"))  # the shorter list is hashed

    def of_these(names: Column) -> Column:
        return F.when(F.size("both") > 0, F.size(F.array_intersect(names, "both"))).otherwise(0).cast("long")

    mine, other, three = of_these(F.col("new")), of_these(F.col("o_new")), of_these(F.array_intersect("new", "o_new"))
    by_count = [F.size("both") - mine - other + three, mine + other - 2 * three, three]
    sums = [F.struct(F.lit(c).alias("c"), F.coalesce(F.sum(n), F.lit(0)).alias("n")) for c, n in enumerate(by_count, 1)]
    return met.agg(F.array(*sums).alias("all")).select(F.explode("all").alias("e")).select("e.c", "e.n")


def add_edges(edges: DataFrame, folder: str, batch_id: int | str) -> int:
    """Add a batch of edges (src, dst); the number of triangles of all batches so far.

    Loops, repeated edges and those of earlier batches add nothing, and a batch that was added before changes nothing.
    """
    spark = edges.sparkSession
    now = manifest.manifest(spark, folder) or {"version": 0, "tables": {"edges": [], "degrees": []}, "info": {"batches": [], "triangles": 0}}
    info = now["info"]
    if batch_id in info["batches"]:
        return info["triangles"]
    old = _all(spark, now["tables"]["edges"], "u long, v long")
    new = materialize(simple_undirected(edges).join(old, ["u", "v"], "left_anti").select("u", "v"), "new-edges")
    own = materialize(degrees(new), "new-degrees")
    degree = _all(spark, now["tables"]["degrees"], "vertex long, degree long").unionAll(own).groupBy("vertex").agg(F.sum("degree").alias("degree"))
    triangles = info["triangles"] + new_triangles(old, new, degree)
    tables = {"edges": [*now["tables"]["edges"], manifest.stage(new, folder)], "degrees": [*now["tables"]["degrees"], manifest.stage(own, folder)]}
    manifest.commit(spark, folder, tables, {"batches": [*info["batches"], batch_id], "triangles": triangles}, now["version"])
    return triangles


def triangle_count(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``n_triangles`` of all batches so far."""
    found = manifest.manifest(spark, folder)
    return spark.createDataFrame([(found["info"]["triangles"] if found else 0,)], "n_triangles long")
