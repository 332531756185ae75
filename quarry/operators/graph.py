"""Undirected-graph operators: symmetrised edges, adjacency, wedges and triangles.

Triangles follow the degree ordering of Suri & Vassilvitskii ("Counting triangles and the curse of the last reducer",
WWW 2011): every edge points from the endpoint of lower (degree, id) to the higher one, so a vertex has at most
sqrt(2m) out-neighbours. A triangle is a common out-neighbour of both ends of an edge, found by intersecting their
out-lists; no wedge is ever a row. Out-lists are cut into blocks by a hash of the neighbour, so an edge meets block
against like block and the work of one vertex spreads over the blocks and over its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numbers import floor_div
from quarry.session import materialize

ADJACENCY_CHUNK = 1024


def symmetrize_distinct(edges: DataFrame) -> DataFrame:
    """``(u, v)`` and ``(v, u)`` for every edge, without duplicates (self-loops appear once)."""
    both = F.explode(F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    ))
    return edges.select(both.alias("e")).select("e.src", "e.dst").distinct()


def simple_undirected(edges: DataFrame) -> DataFrame:
    """Each undirected edge once as ``(u, v)`` with ``u < v``; self-loops dropped."""
    return (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
        .filter(F.col("u").isNotNull() & F.col("v").isNotNull())  # as a join would add: all readers share one exchange
        .distinct()
    )


def degrees(und: DataFrame) -> DataFrame:
    """``(vertex, degree)`` over simple undirected edges (partial aggregation absorbs hubs)."""
    ends = und.select(F.explode(F.array("u", "v")).alias("vertex"))
    return ends.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))


def adjacency_chunks(sym: DataFrame, chunk: int = ADJACENCY_CHUNK) -> DataFrame:
    """Adjacency lists in bounded pieces: ``(vertex, chunk, neighbors)`` sorted ascending.

    A piece holds the neighbours with ids in ``[chunk*c, chunk*(c+1))``, so no row ever holds more
    than ``chunk`` ids, whatever the vertex degree. Concatenating pieces in chunk order gives the
    full sorted list.
    """
    c = floor_div(F.col("dst"), chunk)
    return (
        sym.groupBy(F.col("src").alias("vertex"), c.alias("chunk"))
        .agg(F.sort_array(F.collect_list("dst")).alias("neighbors"))
    )


def ordered_wedge_counts(und: DataFrame) -> DataFrame:
    """Paths ``a - b - c`` with ``a < b < c`` per centre ``b``: (#lower nbrs) x (#higher nbrs).

    Counted from degrees split by side, never enumerated. Centres with no such path are omitted.
    """
    sides = und.select(
        F.explode(F.array(
            F.struct(F.col("v").alias("vertex"), F.lit(1).alias("lower"), F.lit(0).alias("higher")),
            F.struct(F.col("u").alias("vertex"), F.lit(0).alias("lower"), F.lit(1).alias("higher")),
        )).alias("s")
    ).select("s.*")
    per = sides.groupBy("vertex").agg(F.sum("lower").alias("lower"), F.sum("higher").alias("higher"))
    return (
        per.select(F.col("vertex").alias("center"), (F.col("lower") * F.col("higher")).cast("long").alias("n_wedges"))
        .filter(F.col("n_wedges") > 0)
    )


def oriented_edges(und: DataFrame) -> DataFrame:
    """``(s, t, dt)``: each edge from lower to higher (degree, id), and the degree of t."""
    deg = degrees(und)
    du = deg.select(F.col("vertex").alias("u"), F.col("degree").alias("du"))
    dv = deg.select(F.col("vertex").alias("v"), F.col("degree").alias("dv"))
    e = und.join(du, "u").join(dv, "v")
    forward = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    return e.select(
        F.when(forward, F.col("u")).otherwise(F.col("v")).alias("s"),
        F.when(forward, F.col("v")).otherwise(F.col("u")).alias("t"),
        F.greatest("du", "dv").alias("dt"),
    )


OUT_BLOCK = 1024


def out_blocks(und: DataFrame, block: int = OUT_BLOCK) -> DataFrame:
    """Out-lists in blocks: ``(s, nb, blk, out)``, written once to the checkpoint folder.

    A vertex with ``d`` out-neighbours has ``nb`` blocks, the power of two at or above ``d / block``, and neighbour t
    is in block ``pmod(xxhash64(t), nb)``: like numbers of blocks line up for any two vertices. ``out`` is sorted by
    (degree, id), the order in which edges point.
    """
    o = oriented_edges(und)
    nb = o.groupBy("s").agg(F.expr(f"shiftleft(1, cast(ceil(log2(greatest(count(1) / {block}, 1))) as int))").alias("nb"))
    blocked = o.join(nb, "s").withColumn("blk", F.pmod(F.xxhash64("t"), F.col("nb")).cast("int"))
    ordered = F.sort_array(F.collect_list(F.struct("dt", "t")))
    return materialize(blocked.groupBy("s", "nb", "blk").agg(ordered.getField("t").alias("out")), "out-blocks")


def _like_blocks(sided: DataFrame) -> DataFrame:
    """``(s, t, out, tblk)`` of rows ``(s, nb, blk, out, t, nt)``: block i of s meets the blocks j of t with i = j modulo
    the smaller number of blocks."""
    target = F.when(F.col("nt") <= F.col("nb"), F.array(F.expr("blk % nt"))).otherwise(F.sequence(F.col("blk"), F.col("nt") - 1, F.col("nb")))
    return sided.select("s", "t", "out", F.explode(target).alias("tblk"))


def dealt_lists(lists: DataFrame) -> DataFrame:
    """``(s, t, out, tblk)``: for every edge of :func:`out_blocks`, the neighbours of s to look for in block ``tblk`` of t.

    A common neighbour stands behind t in the order, so of a list in one block only what is behind t goes along. The
    vertices of several blocks, fewer than one for ``block`` edges, are broadcast.
    """
    several = F.broadcast(lists.filter("nb > 1").select(F.col("s").alias("t"), F.col("nb").alias("nt")).distinct())
    single = lists.filter("nb = 1").select("s", "nb", "blk", "out", F.posexplode("out").alias("pos", "t")).filter("pos < size(out) - 1")
    behind = single.select("s", "nb", "blk", F.expr("slice(out, pos + 2, size(out))").alias("out"), "t")
    mine = lists.filter("nb > 1").select("s", "nb", "blk", "out")
    many = mine.join(mine.select("s", F.explode("out").alias("t")), "s").select("s", "nb", "blk", "out", "t")
    return _like_blocks(behind.unionAll(many).join(several, "t", "left").select("s", "nb", "blk", "out", "t", F.coalesce("nt", F.lit(1)).alias("nt")))


def common_out_neighbours(und: DataFrame, block: int = OUT_BLOCK) -> DataFrame:
    """``(s, t, common)``: for each oriented edge and pair of like blocks, the out-neighbours of both ends (if any).

    Every edge (s, t) is dealt by (t, block): the edges of one source go to as many keys as it has neighbours and
    blocks. A target with very many sources is a hot key of the last join, with one row on the other side, which AQE
    splits (both sides are plain shuffles of the written table).
    """
    lists = out_blocks(und, block)
    theirs = lists.select(F.col("s").alias("t"), F.col("blk").alias("tblk"), F.col("out").alias("t_out"))
    met = dealt_lists(lists).join(theirs, ["t", "tblk"])
    return met.select("s", "t", F.array_intersect("out", "t_out").alias("common")).filter(F.size("common") > 0)


def triangles(und: DataFrame, block: int = OUT_BLOCK) -> DataFrame:
    """Every triangle once as ``(a, b, c)`` with ``a < b < c`` (ids)."""
    tri = common_out_neighbours(und, block).select(F.explode("common").alias("x"), "s", "t")
    vs = F.array("s", "t", "x")
    return tri.select(F.array_min(vs).alias("a"), F.element_at(F.array_sort(vs), 2).alias("b"), F.array_max(vs).alias("c"))


def triangles_per_vertex(und: DataFrame, block: int = OUT_BLOCK) -> DataFrame:
    """Triangles counted at their smallest vertex id: ``(vertex, n_triangles)``, zeros omitted."""
    found = common_out_neighbours(und, block).select(F.explode("common").alias("x"), "s", "t")
    return found.groupBy(F.least("s", "t", "x").alias("vertex")).agg(F.count(F.lit(1)).alias("n_triangles"))


def triangle_count(und: DataFrame, block: int = OUT_BLOCK) -> DataFrame:
    """One row ``n_triangles``; 0 for a graph without triangles."""
    sizes = common_out_neighbours(und, block).agg(F.sum(F.size("common")).alias("n"))
    return sizes.select(F.coalesce("n", F.lit(0)).cast("long").alias("n_triangles"))
