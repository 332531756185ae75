"""Whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def floor_div(value: Column, n: int) -> Column:
    """``floor(value / n)`` for whole numbers and n > 0, exact over the whole long range."""
    value = value.cast("long")
    return F.call_function("div", value, F.lit(n).cast("long")) - F.when(value % n < 0, 1).otherwise(0)
