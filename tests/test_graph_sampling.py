"""Two-paths drawn from all: even, repeatable, and the interval holds the true number of triangles."""

import random
from collections import Counter
from itertools import combinations

from quarry.operators import graph, graph_sampling

R = random.Random(9)
EDGES = sorted({tuple(sorted(R.sample(range(25), 2))) for _ in range(90)} | {(0, k) for k in range(1, 25)})


def test_draws_are_even_over_all_two_paths(spark):
    und = spark.createDataFrame(EDGES, "u long, v long").repartition(5)
    near = {v: sorted({a + b - v for a, b in EDGES if v in (a, b)}) for v in range(25)}
    every = [(c, a, b) for c, n in near.items() for a, b in combinations(n, 2)]
    draws = 20 * len(every)
    got = graph_sampling.sample_two_paths(und, draws, seed=4).collect()
    assert len(got) == draws and {x.n_paths for x in got} == {len(every)} and sorted(x.draw for x in got) == list(range(draws))
    count = Counter((x.center, x.a, x.b) for x in got)
    assert set(count) <= set(every)
    chi2 = sum((count[p] - 20) ** 2 / 20 for p in every)
    assert abs(chi2 - len(every)) < 5 * (2 * len(every)) ** 0.5
    assert all(x.closed == ((x.a, x.b) in EDGES) for x in got)
    assert sorted(got) == sorted(graph_sampling.sample_two_paths(und.repartition(2), draws, seed=4).collect())


def test_the_interval_holds_the_true_count(spark):
    und = spark.createDataFrame(EDGES, "u long, v long")
    true = graph.triangle_count(und).first()[0]
    found = graph_sampling.estimated_triangles(graph_sampling.sample_two_paths(und, 3000, seed=1))
    assert 0 < found["low"] < true < found["high"] and found["draws"] == 3000 and abs(found["estimate"] - true) < 0.3 * true


def test_no_two_paths(spark):
    paths = graph_sampling.sample_two_paths(spark.createDataFrame([(1, 2), (3, 4)], "u long, v long"), 10)
    assert paths.count() == 0 and graph_sampling.estimated_triangles(paths)["estimate"] == 0
