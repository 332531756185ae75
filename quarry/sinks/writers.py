"""Sinks: tuple-text lines, TAB-separated key/value text, and columnar output.

Writes go through Spark's committers (one file per partition, atomic job commit). The replace
policy is explicit: ``overwrite`` replaces the target, ``errorifexists`` refuses an existing one.
Fixed output file counts are honoured by ``num_files`` with a range repartition when the rows are
ordered (file order = total order) and a plain repartition otherwise, so that the work before it keeps its tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import sorted_by_range


def tuple_text(df: DataFrame) -> Column:
    """``(f1,f2,...)``: the text form of a tuple row; NULL prints as ``null``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))


def tab_text(df: DataFrame) -> Column:
    """``f1<TAB>f2...``: key/value text output; NULL prints as an empty field."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])


def _shape(df: DataFrame, num_files: int | None, order: list | None) -> DataFrame:
    if num_files is None:
        return df
    if order:
        return sorted_by_range(df, order, num_files)
    return df.repartition(num_files)


def write_tuple_text(df: DataFrame, path: str, mode: str = "errorifexists", num_files: int | None = None,
                     order: list | None = None, columns: list[str] | None = None) -> None:
    """One ``(f1,f2,...)`` line per row of ``columns`` (default: all), optionally ordered."""
    shown = df.select(*columns) if columns else df
    _shape(df, num_files, order).select(tuple_text(shown).alias("value")).write.mode(mode).text(path)


def write_tab_text(df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None,
                   order: list | None = None, columns: list[str] | None = None) -> None:
    """One ``f1<TAB>f2...`` line per row of ``columns`` (default: all), optionally ordered."""
    shown = df.select(*columns) if columns else df
    _shape(df, num_files, order).select(tab_text(shown).alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
