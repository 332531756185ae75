"""Tables kept between runs: versions that appear whole, counts and triangles of batches that are applied once."""

import os
import random
from collections import Counter
from itertools import combinations

import pytest

from quarry.operators import graph, graph_increments, kept_counts
from quarry.sinks import manifest, writers


def test_two_outputs_appear_together(spark, tmp_path):
    folder = str(tmp_path / "pair")
    assert manifest.manifest(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, folder, "log")
    one, two = (spark.createDataFrame([(k, "x")], "n int, s string") for k in (1, 2))
    manifest.publish(spark, folder, {"log": one, "counts": one})

    def broken(df, path):
        df.write.parquet(path)
        raise OSError("the disk is full")

    with pytest.raises(OSError):
        manifest.publish(spark, folder, {"log": two, "counts": two}, write={"counts": broken})
    assert [manifest.read(spark, folder, t).first()["n"] for t in ("log", "counts")] == [1, 1]
    manifest.publish(spark, folder, {"log": two, "counts": two}, {"by": "test"})
    assert [manifest.read(spark, folder, t).first()["n"] for t in ("log", "counts")] == [2, 2]
    assert [manifest.read(spark, folder, t, 1).first()["n"] for t in ("log", "counts")] == [1, 1]
    assert manifest.manifest(spark, folder)["info"] == {"by": "test"}
    with pytest.raises(RuntimeError, match="exists already"):  # a writer that began before
        manifest.commit(spark, folder, {}, after=1)
    manifest.drop_old(spark, folder, keep=1)
    assert manifest.versions(spark, folder) == [2] and len(os.listdir(f"{folder}/data")) == 2
    assert manifest.read(spark, folder, "log").first()["n"] == 2


def test_text_outputs_can_be_published(spark, tmp_path):
    folder = str(tmp_path / "text")
    df = spark.createDataFrame([("b", 2), ("a", 1)], "s string, n int")
    manifest.publish(spark, folder, {"lines": df}, write={"lines": lambda d, path: writers.write_tab_text(d, path, num_files=1, order=["n"])})
    (path,) = manifest.manifest(spark, folder)["tables"]["lines"]
    assert [r.value for r in spark.read.text(path).collect()] == ["a\t1", "b\t2"]


def test_counts_of_batches_are_added_once(spark, tmp_path):
    folder, r, want = str(tmp_path / "counts"), random.Random(3), Counter()
    for batch in range(7):
        own = Counter((r.choice("abc"), r.choice(["x", None])) for _ in range(50))
        df = spark.createDataFrame([(*k, n) for k, n in own.items()], "w1 string, w2 string, n long")
        assert kept_counts.add(df, folder, batch, buckets=4, most_parts=3)
        assert not kept_counts.add(df, folder, batch)
        want += own
        got = kept_counts.total(spark, folder, ["w1", "w2"])
        assert {(x.w1, x.w2): x.n for x in got.collect()} == dict(want)
    assert len(manifest.manifest(spark, folder)["tables"]["counts"]) <= 4
    assert kept_counts.lookup(spark, folder, {"w1": "a", "w2": "x"}) == want["a", "x"]


def test_a_failed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "counts")
    df = spark.createDataFrame([("a", 2)], "w string, n long")
    kept_counts.add(df, folder, "mon")
    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            kept_counts.add(df, folder, "tue")
    assert kept_counts.total(spark, folder, ["w"]).first()["n"] == 2
    assert kept_counts.add(df, folder, "tue") and kept_counts.total(spark, folder, ["w"]).first()["n"] == 4


def test_triangles_of_arriving_edges(spark, tmp_path):
    folder, r = str(tmp_path / "edges"), random.Random(4)
    edges, so_far = [(r.randrange(14), r.randrange(14)) for _ in range(90)] + [(0, k) for k in range(1, 14)] * 2, set()
    r.shuffle(edges)
    for batch in range(4):
        own = edges[batch::4] if batch else edges[::4] + edges[1:9]
        so_far |= {(min(e), max(e)) for e in own if e[0] != e[1]}
        want = sum((a, b) in so_far and (a, c) in so_far and (b, c) in so_far for a, b, c in combinations(range(14), 3))
        df = spark.createDataFrame(own, "src long, dst long")
        assert graph_increments.add_edges(df, folder, batch) == want
        assert graph_increments.add_edges(df, folder, batch) == want
    whole = graph.triangle_count(graph.simple_undirected(spark.createDataFrame(edges, "src long, dst long"))).first()[0]
    assert graph_increments.triangle_count(spark, folder).first()[0] == whole == want > 10
