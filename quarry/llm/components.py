"""Connected components of an edge table, and tables written to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores behind it as no column has (names differ by more than case)."""
    used = {c.lower() for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def materialised(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder of ``spark.checkpoint.dir`` and read back from there."""
    return materialize(df, "llm")


def _dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``materialised`` has written and nothing reads any more."""
    jvm = df.sparkSession._jvm
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; the component is its smallest node.

    Alternates the large-star and small-star steps (each a grouped minimum and an equi-join) until no edge changes;
    the number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder.
    Edges with a null end are ignored. An empty edge table gives an empty result.
    """
    pairs = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") != F.col("hi")))
    pairs = materialised(pairs.distinct())
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.min("hi").alias("near")).select(F.col("lo").alias("u"), F.least("lo", "near").alias("m"))
        large = (
            pairs.join(least, pairs["lo"] == least["u"]).select(F.col("m").alias("lo"), "hi").filter("lo <> hi").distinct()
        )
        large = materialised(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi").select("hi", "lo", "m")
            .select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("hi")), F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e"))
            .select("e.lo", "e.hi").filter("lo <> hi").distinct()
        )
        old, pairs = pairs, materialised(small)
        _dropped(old)
        _dropped(large)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
