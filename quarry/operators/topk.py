"""Top-k: global (partial + final top-k by Spark) and per group (WindowGroupLimit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Global top ``k`` by ``order`` with a 1-based ``rank``.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: every task keeps its own k best and
    one final task merges them, so only ``k x tasks`` rows move. The rank window then runs on
    at most ``k`` rows.
    """
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows of each group by ``order`` with a 1-based ``rank`` (ties broken by ``order``).

    ``row_number() <= k`` lets Catalyst insert a partial ``WindowGroupLimit`` before the shuffle,
    so each task forwards at most ``k`` rows per group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (
        df.withColumn(rank_col, F.row_number().over(w).cast("long"))
        .filter(F.col(rank_col) <= k)
    )
