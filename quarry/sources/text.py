"""Text sources and record parsers.

Scans are Spark's own (``read.text``, ``read.csv``); parsing is column expressions on the line, so
Catalyst prunes the fields a query does not use. Bad-input policy is explicit per parser and the same under any
session setting: ``strict=True`` fails the job on a bad number or a missing field, otherwise Pig's rules hold.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import java_split

# Field positions of the record formats the queries read (fixed by the formats).
TRACE_FIELDS = {"time": 0, "connection_id": 1, "source_ip": 2, "destination_ip": 4}
TRACE_PROTOCOL_FIELD = 5
VERDICT_FIELDS = {"connection_id": 0, "action": 1}
REPOSITORY_FIELDS = {"name": 0, "language": 1, "stars": 12}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line (LF, CRLF or CR ends a line); a path may be a directory."""
    return spark.read.text(path)


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a file-order key: ``(_file, _split, _row, value)``.

    ``_row`` (a monotonically increasing id) only orders rows inside one split, so the record
    order is (file, split start, row). Splits are packed by size, so the id alone is not file order.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )


def split_key_value(line: str | Column = "value") -> list[Column]:
    """Key before the first TAB and the rest as value; no TAB -> whole line is key, value ''."""
    c = F.col(line) if isinstance(line, str) else line
    parts = F.split(c, "\t", 2)
    return [parts.getItem(0).alias("key"), F.coalesce(F.get(parts, 1), F.lit("")).alias("value")]


_WHOLE = {"int": "int", "integer": "int", "long": "bigint", "bigint": "bigint"}
_RANGE = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}
#: A decimal number as Java's Double.valueOf reads it, blanks around it included.
_DECIMAL = "^[\\x00-\\x20]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[\\x00-\\x20]*\\z"


def strict_field(field: Column, dtype: str, name: str) -> Column:
    """The field as ``dtype``; a missing field or a bad number raises, whatever the session's ANSI setting.

    Whole numbers are digits with an optional sign and nothing else (``Integer.parseInt``), so blanks around them fail.
    """
    whole = _WHOLE.get(dtype)
    value = field if dtype == "string" else field.try_cast(whole or dtype)
    good = value.isNotNull() & (field.rlike("^[+-]?[0-9]+\\z") if whole else F.lit(True))
    message = F.concat(F.lit(f"bad {name}: "), F.coalesce(field, F.lit("missing")))
    return F.when(good, value).otherwise(F.raise_error(message).cast(whole or dtype))


def pig_field(field: Column, dtype: str) -> Column:
    """The field as Pig loads it: empty is NULL; a decimal read as a whole number is cut towards zero; what is no
    number, or beyond the type's largest, is NULL, and below its smallest is the smallest."""
    field = F.nullif(field, F.lit(""))
    if dtype == "string":
        return field
    whole = _WHOLE.get(dtype)
    if whole is None:
        return field.try_cast(dtype)
    low, high = _RANGE[whole]
    plain = F.when(field.rlike("^[+-]?[0-9]+\\z"), field.try_cast(whole))
    number = F.when(field.rlike(_DECIMAL), F.regexp_replace(field, "[\\x00-\\x20]", "").try_cast("double"))
    cut = F.when(number >= float(high) + (1 if whole == "int" else 0), F.lit(None)).when(number <= float(low), F.lit(low)).otherwise(number)
    return F.coalesce(plain, cut.try_cast(whole))


def parse_positional(lines: DataFrame, sep: str, fields: dict[str, tuple[int, str]], line_col: str = "value",
                     strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Pick fields by position from ``sep``-split lines and type them.

    Missing and empty fields are NULL (``pig_field``); with ``strict`` a missing field or bad number fails
    (``strict_field``). ``sep`` is a regex, as in ``String.split``; trailing empty fields are dropped like Java does.
    The line is split once: the generator keeps a filter on a field, which the optimizer would else push below the split
    together with a copy of it, above.
    """
    keep = keep or []
    split = lines.select(*keep, F.explode(F.array(java_split(F.col(line_col), sep))).alias("_parts"))
    cols = []
    for name, (idx, dtype) in fields.items():
        raw = F.get(F.col("_parts"), F.lit(idx))
        cols.append((strict_field(raw, dtype, name) if strict else pig_field(raw, dtype)).alias(name))
    return split.select(*keep, *cols)


def parse_delimited(lines: DataFrame, sep: str, schema: list[tuple[str, str]], line_col: str = "value",
                    keep: list[str] | None = None) -> DataFrame:
    """``LOAD ... USING PigStorage(sep) AS (schema)``: all fields by position, NULL on bad casts."""
    return parse_positional(lines, sep, {n: (i, t) for i, (n, t) in enumerate(schema)}, line_col, keep=keep)


def read_delimited(spark: SparkSession, path: str, sep: str, schema: list[tuple[str, str]]) -> DataFrame:
    """File form of :func:`parse_delimited`."""
    return parse_delimited(read_lines(spark, path), sep, schema)


def parse_trace(lines: DataFrame, line_col: str = "value", strict: bool = True,
                keep: list[str] | None = None) -> DataFrame:
    """IP trace record: time, connection id, source IP, '>' mark, destination IP (space-separated)."""
    fields = {
        "time": (TRACE_FIELDS["time"], "string"),
        "connection_id": (TRACE_FIELDS["connection_id"], "int"),
        "source_ip": (TRACE_FIELDS["source_ip"], "string"),
        "destination_ip": (TRACE_FIELDS["destination_ip"], "string"),
    }
    return parse_positional(lines, " ", fields, line_col, strict=strict, keep=keep)


def parse_network_events(lines: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Network trace without schema: fields 2, 4, 5 as source, destination, protocol."""
    fields = {
        "source_ip": (TRACE_FIELDS["source_ip"], "string"),
        "destination_ip": (TRACE_FIELDS["destination_ip"], "string"),
        "protocol": (TRACE_PROTOCOL_FIELD, "string"),
    }
    return parse_positional(lines, " ", fields, line_col, keep=keep)


def parse_verdicts(lines: DataFrame, line_col: str = "value", strict: bool = True,
                   keep: list[str] | None = None) -> DataFrame:
    """Firewall verdicts ``connection_id action`` (space-separated, extra fields ignored)."""
    fields = {"connection_id": (VERDICT_FIELDS["connection_id"], "int"),
              "action": (VERDICT_FIELDS["action"], "string")}
    return parse_positional(lines, " ", fields, line_col, strict=strict, keep=keep)


def parse_repositories(lines: DataFrame, line_col: str = "value", strict: bool = True,
                       keep: list[str] | None = None) -> DataFrame:
    """Repository list, naive comma split (no quoting): name, language, stars at 0, 1, 12."""
    fields = {"name": (REPOSITORY_FIELDS["name"], "string"),
              "language": (REPOSITORY_FIELDS["language"], "string"),
              "stars": (REPOSITORY_FIELDS["stars"], "int")}
    return parse_positional(lines, ",", fields, line_col, strict=strict, keep=keep)


def parse_edges(lines: DataFrame, sep: str = "\t", line_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """Edge list: exactly two ``Long.parseLong`` fields, anything else dropped (as a NULL edge).

    Java's split drops trailing empty fields, so ``1<TAB>2<TAB>`` is an edge and
    ``1<TAB>2<TAB>3`` is not: one anchored regex decides, a split on the separator reads the ids
    (an id beyond the long range fails ``try_cast`` and is dropped, as ``parseLong`` would fail).
    """
    s = re.escape(sep)
    pattern = f"^[+-]?[0-9]+{s}[+-]?[0-9]+(?:{s})*\\z"
    line = F.col(line_col)
    # One anchored regex validates the whole line; the ids then come from a split on the
    # separator (a plain character split when it is one literal character).
    parts = F.split(line, s, -1)
    parsed = lines.filter(line.rlike(pattern)).select(
        *(keep or []),
        parts.getItem(0).try_cast("long").alias("src"),
        parts.getItem(1).try_cast("long").alias("dst"),
    )
    return parsed.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """Key/value text input: ``(key, value)`` split at the first TAB."""
    return read_lines(spark, path).select(*split_key_value("value"))


def read_trace(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_trace(read_lines(spark, path), strict=strict)


def read_network_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_network_events(read_lines(spark, path))


def read_verdicts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_verdicts(read_lines(spark, path), strict=strict)


def read_repositories(spark: SparkSession, path: str, naive: bool = True, strict: bool = True) -> DataFrame:
    """Repository CSV. ``naive`` splits on every comma (the reference's parser); otherwise
    Spark's CSV reader with quoting picks columns 0, 1 and 12."""
    if naive:
        return parse_repositories(read_lines(spark, path), strict=strict)
    raw = spark.read.option("header", "false").option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path)
    cols = raw.columns
    return raw.select(F.col(cols[0]).alias("name"), F.col(cols[1]).alias("language"),
                      (F.col(cols[12]).cast("int") if strict else F.col(cols[12]).try_cast("int")).alias("stars"))


def read_edges(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    return parse_edges(read_lines(spark, path), sep=sep)
