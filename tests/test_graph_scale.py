"""Triangles: an edge takes along only what can close a triangle, and the edges are made distinct once."""

import random
from itertools import combinations

import pytest

from quarry.operators import graph, graph_increments


def _edges(n, m, seed):
    r = random.Random(seed)
    return [(r.randrange(n), r.randrange(n)) for _ in range(m)]


def test_lists_go_along_from_behind_the_target(spark):
    n = 12
    clique = spark.createDataFrame(list(combinations(range(n), 2)), "u long, v long")
    rows = graph.dealt_lists(graph.out_blocks(clique)).selectExpr("count(*) as rows", "sum(size(out)) as ids").first()
    # a list of d neighbours: d - 1 targets with d - 1, d - 2, ... 1 of them behind; not d with d each
    assert rows.ids == n * (n - 1) * (n - 2) // 6 and rows.rows == sum(max(d - 1, 0) for d in range(n))


def test_triangles_of_random_graphs_with_and_without_blocks(spark):
    for block, seed in [(1024, 1), (2, 2)]:
        edges = _edges(30, 200, seed)
        sides = {(min(e), max(e)) for e in edges if e[0] != e[1]}
        want = sorted(t for t in combinations(range(30), 3) if all(s in sides for s in combinations(t, 2)))
        und = graph.simple_undirected(spark.createDataFrame([*edges, (1, None), (None, None)], "src long, dst long"))
        assert sorted(tuple(r) for r in graph.triangles(und, block).collect()) == want and len(want) > 50


def test_readers_of_the_edges_share_one_exchange(spark, tmp_path):
    path = str(tmp_path / "edges")
    spark.createDataFrame(_edges(40, 300, 3), "src long, dst long").write.parquet(path)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = graph.oriented_edges(graph.simple_undirected(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("longest", [0, 8, 1024])
def test_new_triangles_by_lists_and_by_rows(spark, longest):
    edges = sorted({(min(e), max(e)) for e in _edges(25, 220, 7) if e[0] != e[1]} | {(0, k) for k in range(1, 25)})
    r = random.Random(8)
    fresh = {e for e in edges if r.random() < 0.4}
    want = sum(all(s in edges for s in combinations(t, 2)) and any(s in fresh for s in combinations(t, 2)) for t in combinations(range(25), 3))
    old, new = (spark.createDataFrame([e for e in edges if (e in fresh) == k], "u long, v long") for k in (False, True))
    degree = graph.degrees(old.unionAll(new))
    assert graph_increments.new_triangles(old, new, degree, longest) == want > 50
    assert graph_increments.new_triangles(old.limit(0), old.unionAll(new), degree, longest) == graph.triangle_count(old.unionAll(new)).first()[0]


def test_short_lists_make_no_row_of_a_neighbour(spark, monkeypatch):
    """A new edge between short lists is one row of the last join, whatever the number of its neighbours."""
    n, rows = 20, []
    clique = spark.createDataFrame(list(combinations(range(n), 2)), "u long, v long")
    lists = graph_increments._by_lists

    def counted(edges, around, hubs):
        rows.append((edges.count(), hubs.count()))
        return lists(edges, around, hubs)

    monkeypatch.setattr(graph_increments, "_by_lists", counted)
    assert graph_increments.new_triangles(clique.limit(0), clique, graph.degrees(clique)) == n * (n - 1) * (n - 2) // 6
    assert rows == [(n * (n - 1) // 2, 0)]
