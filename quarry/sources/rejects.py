"""Lines that do not parse, kept with their reason instead of dropped: one scan gives the records and the rejects.

``edges_with_reason`` and ``fields_with_reason`` parse like ``sources.text`` and add ``line`` and ``reason`` (null for a good
line). ``write_checked`` writes them in one pass, counts both by an ``Observation`` of that pass, and publishes records and
rejects together, or nothing if the share of rejects is above the allowed one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import java_split
from quarry.sinks import manifest

#: Reasons in the order in which they are looked for.
FIELDS, NUMBER, RANGE = "number of fields", "no whole number", "beyond the range"
_WHOLE = "^[+-]?[0-9]+\\z"


class TooManyRejects(ValueError):
    """More lines were rejected than allowed; nothing was published."""


def edges_with_reason(lines: DataFrame, sep: str = "\t", line_col: str = "value") -> DataFrame:
    """``(src, dst, reason, line)`` of every line of an edge list; ``src`` and ``dst`` are null with a reason."""
    split = lines.select(F.col(line_col).alias("line"), F.explode(F.array(java_split(F.col(line_col), sep))).alias("p"))
    parts = [F.get("p", F.lit(k)) for k in range(2)]
    numbers = [p.try_cast("long") for p in parts]
    reason = (
        F.when(F.col("line").isNull() | (F.size("p") != 2), FIELDS)
        .when(~(parts[0].rlike(_WHOLE) & parts[1].rlike(_WHOLE)), NUMBER)
        .when(numbers[0].isNull() | numbers[1].isNull(), RANGE)
    )
    judged = split.select("line", reason.alias("reason"), *(n.alias(c) for n, c in zip(numbers, ("src", "dst"))))
    return judged.select(*(F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in ("src", "dst")), "reason", "line")


def fields_with_reason(lines: DataFrame, sep: str, fields: dict[str, tuple[int, str]], line_col: str = "value") -> DataFrame:
    """Typed fields by position (``int``, ``long`` or ``string``) with ``reason`` and ``line``; the reason names the first bad field."""
    split = lines.select(F.col(line_col).alias("line"), F.explode(F.array(java_split(F.col(line_col), sep))).alias("p"))
    reason: Column = F.lit(None).cast("string")
    values = []
    for name, (at, dtype) in reversed(fields.items()):
        raw = F.get("p", F.lit(at))
        if dtype == "string":
            value = raw
        else:
            value = F.when(raw.rlike(_WHOLE), raw.try_cast(dtype))
            reason = F.when(~raw.rlike(_WHOLE), f"{name}: {NUMBER}").when(raw.isNotNull() & value.isNull(), f"{name}: {RANGE}").otherwise(reason)
        reason = F.when(raw.isNull(), f"{name}: missing").otherwise(reason)
        values.insert(0, value.alias(name))
    judged = split.select(*values, reason.alias("reason"), "line")
    return judged.select(*(F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in fields), "reason", "line")


def write_checked(judged: DataFrame, folder: str, most_rejects: float = 1.0) -> dict[str, int]:
    """Write lines with ``reason`` once; ``{"lines": n, "rejects": n}``. Raises ``TooManyRejects`` above that share and publishes nothing."""
    spark = judged.sparkSession
    seen = Observation()
    rejected = F.col("reason").isNotNull()
    counted = judged.withColumn("rejected", rejected).observe(seen, F.count(F.lit(1)).alias("lines"), F.count(F.when(rejected, 1)).alias("rejects"))
    path = manifest.stage(counted, folder, lambda df, at: df.write.partitionBy("rejected").parquet(at))
    found = {k: int(v) for k, v in seen.get.items()}
    if found["rejects"] > most_rejects * found["lines"]:
        raise TooManyRejects(f"{found['rejects']} of {found['lines']} lines rejected, {most_rejects:.2%} allowed")
    now = manifest.manifest(spark, folder)
    manifest.commit(spark, folder, {"lines": [path]}, found, now["version"] if now else 0)
    return found


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The good lines' fields of the newest version."""
    return manifest.read(spark, folder, "lines").filter("rejected = 'false'").drop("rejected", "reason", "line")


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    """``(line, reason)`` of the others."""
    return manifest.read(spark, folder, "lines").filter("rejected = 'true'").select("line", "reason")
