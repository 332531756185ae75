"""Whitening against numpy's own eigenvectors and whole-number arithmetic, and the eigenpairs of odd matrices."""

import collections
import math

import numpy as np
import pytest

from quarry.llm import eigen, whitening

R = np.random.default_rng(3)
Q = np.linalg.qr(R.standard_normal((24, 24)))[0]
MATRICES = {
    "sample": (lambda b: b.T @ b / 90)(R.standard_normal((90, 24))),
    "clusters": Q @ np.diag([5.0] * 6 + [5 + 1e-13] * 4 + [1.0] * 9 + [0.0] * 5) @ Q.T,
    "diagonal": np.diag(np.arange(12.0)),
    "equal": np.eye(7),
    "one": np.array([[2.0]]),
    "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
    "zero": np.zeros((3, 3)),
    "negative": -np.diag([3.0, 1.0, 2.0]),
    "low rank": (lambda b: b.T @ b)(R.standard_normal((3, 24))),
    "tiny": 1e-200 * (Q @ np.diag(np.arange(24.0)) @ Q.T),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_eigenpairs(name):
    a = MATRICES[name]
    for k in (1, len(a)):
        values, x = eigen.leading(a, k)
        norm = max(np.abs(a).max(), 1e-300)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * norm * len(a)
        assert np.abs(a @ x - x * values).max() <= 1e-13 * norm * len(a)
        assert np.abs(x.T @ x - np.eye(k)).max() < 1e-13


def test_sturm_counts():
    diagonal, off = np.array([2.0, 2.0, 5.0]), np.array([1.0, 0.0])  # eigenvalues 1, 3, 5
    assert eigen.count_below(diagonal, off, np.array([0.0, 2.0, 4.0, 6.0])).tolist() == [0, 1, 2, 3]


def brute(rows, components):
    """{row number: [(component, n, deviation, |whitened|, explained)]}, with exact sums."""
    good = {k: [math.floor(64 * c) + 1_000_000 for c in v] for k, (_, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v)}
    lengths = collections.Counter(map(len, good.values()))
    d = max(lengths, key=lambda x: (lengths[x], x), default=0)
    good = {k: x for k, x in good.items() if len(x) == d}
    n = len(good)
    if not n:
        return {}
    sums = [sum(x[i] for x in good.values()) for i in range(d)]
    centred = {k: np.array([(n * x[i] - sums[i]) / n for i in range(d)]) for k, x in good.items()}
    v = sum(np.outer(y, y) for y in centred.values()) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    used = [j for j in range(min(d, components)) if e[j] > 1e-9 * max(e[0], 0)]
    return {
        k: [(j + 1, n, sum((n * x[i] - sums[i]) ** 2 for i in range(d)), centred[k] @ q[:, j] / math.sqrt(e[j]), e[j] / np.trace(v)) for j in used] for k, x in good.items()
    }


def check(spark, rows, components=32, kind="float"):
    table = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], f"vec_id long, embedding array<{kind}>, n string, component int").repartition(3)
    got = whitening.whiten(table, components=components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    want = brute(rows, components)
    signs = {}
    found = collections.defaultdict(list)
    for x in got.collect():
        found[x.vec_id].append(x)
        assert x.identity_error < 1e-9
    expect = collections.defaultdict(list)
    for k, own in want.items():
        if own:
            expect[rows[k][0]] += own
    assert {i: sorted((x.component, x.n, x.deviation) for x in own) for i, own in found.items()} == {i: sorted(w[:3] for w in own) for i, own in expect.items()}
    for i, own in found.items():
        for x, w in zip(sorted(own, key=lambda x: (x.component, x.deviation, abs(x.whitened))), sorted(expect[i], key=lambda w: (w[0], w[2], abs(w[3])))):
            if abs(w[3]) > 1e-6:
                assert signs.setdefault(x.component, np.sign(x.whitened * w[3])) * x.whitened == pytest.approx(w[3], rel=1e-6)
            assert x.explained == pytest.approx(w[4], rel=1e-9)
    return found


def test_whitening(spark):
    r = np.random.default_rng(5)
    vectors = (r.standard_normal((300, 9)) * np.arange(1, 10)) @ r.standard_normal((9, 9))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
    rows += [
        (900, None), (901, []), (902, [1.0] * 8), (903, [1.0] * 8 + [None]), (904, [float("nan")] + [0.0] * 8), (905, [float("inf")] + [0.0] * 8), (906, [-float("inf")] * 9),
        (7, rows[7][1]), (7, rows[7][1]), (8, rows[9][1]), (None, rows[3][1]), (None, rows[3][1]),
    ]
    assert len(check(spark, rows)) == 301
    check(spark, rows, components=4)


def test_constant_dimension_and_fewer_vectors_than_dimensions(spark):
    r = np.random.default_rng(6)
    found = check(spark, [(i, [1.5, *map(float, r.standard_normal(6) * 9), 0.0]) for i in range(5)], kind="double")
    assert {len(v) for v in found.values()} == {4}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0, 4.0]), (2, [3.0, 4.0])], [(1, [])]):
        assert check(spark, rows) == {}


def test_large_entries_stay_exact(spark):
    table = spark.createDataFrame([(0, [2.0**45, 1.0]), (1, [-(2.0**45), 3.0]), (2, [1e300, -7.0])], "vec_id long, embedding array<double>")
    centre = whitening._centre(table.select("embedding"))
    x = [[2**51 + 10**6, 64 + 10**6], [-(2**51) + 10**6, 192 + 10**6], [int(9.2e18) + 10**6, -448 + 10**6]]
    assert [w * 3 + r for w, r in zip(centre.whole, centre.rest)] == [sum(v[i] for v in x) for i in range(2)]
    assert [x.deviation for x in whitening.whiten(table, components=1).collect()] == [None] * 3


def test_lengths_beyond_the_bound_are_refused(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MAX_DIMENSION", 2)
    with pytest.raises(ValueError, match="more than 2 entries"):
        whitening.fit(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"))
