"""Equi-join with explicit splitting of hot keys (salting), for when one key holds a large share.

Keys of ``big`` with more than ``hot_rows`` rows are spread over ``salts`` sub-keys (by a hash of the row, so reruns
assign the same salt); the matching rows of ``small`` are replicated once per salt. Other keys join as usual (salt 0).
The hot keys are measured, and the ``MOST_HOT`` most frequent of them are split, which bounds the list that is
broadcast; any key beyond those holds less than one part in ``MOST_HOT`` of the rows and needs no splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_HOT = 10_000


def hot_keys(big: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, at most the ``MOST_HOT`` most frequent (partial aggregation keeps this cheap)."""
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    return counts.orderBy(F.col("_rows").desc(), key).limit(MOST_HOT).select(key)


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                hot_rows: int = 1_000_000, salts: int = 64) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys of ``big`` split over ``salts`` tasks.

    ``how`` is ``inner`` or ``left`` (the side kept whole must be the salted one).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = F.broadcast(hot_keys(big, key, hot_rows).withColumn("_hot", F.lit(True)))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    big_s = (
        big.join(hot, key, "left")
        .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        .drop("_hot")
    )
    small_s = (
        small.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                       .otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return big_s.join(small_s, [key, "_salt"], how).drop("_salt")
