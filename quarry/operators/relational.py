"""Grouped sums, distinct counts, argmax, and the firewall-log join.

All aggregates are Spark built-ins with partial (map-side) aggregation, so a key holding a third
of the rows still costs one partial row per task. ``countDistinct`` plans as a two-level
aggregate keyed first on (key, value), which spreads a hot key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numbers import INTEGRAL
from quarry.functions.text import drop_last_component
from quarry.operators.joins import salted_join
from quarry.operators.topk import top_k

# Fixed values of the queries.
TCP_SPELLINGS = ("tcp", "TCP")
BLOCKED = "Blocked"


def sum_by_key(df: DataFrame, key: str, value: str, out: str = "total", overflow: str = "fail") -> DataFrame:
    """``SUM(value)`` per key; NULLs skipped, an all-NULL group gives NULL.

    ``overflow="fail"`` raises when the sum of a whole-number column leaves the long range; ``"null"`` gives NULL for that
    key. Neither depends on the session's ANSI setting: the sum is taken in 38 digits.
    """
    if df.schema[value].dataType.simpleString() not in INTEGRAL:
        return df.groupBy(key).agg(F.sum(value).alias(out))
    total = F.col(out)
    fits = total.isNull() | total.between(F.lit(-(2**63)), F.lit(2**63 - 1))
    beyond = F.raise_error(F.lit(f"sum of {value} is beyond the long range")).cast("long") if overflow == "fail" else F.lit(None).cast("long")
    sums = df.groupBy(key).agg(F.sum(F.col(value).cast("decimal(28,0)")).alias(out))
    return sums.select(key, F.when(fits, total.cast("long")).otherwise(beyond).alias(out))


def sum_by_key_topk(df: DataFrame, key: str, value: str, k: int = 10, out: str = "total",
                    overflow: str = "fail") -> DataFrame:
    """Top ``k`` keys by summed value, descending with NULL sums last; ties by key."""
    sums = sum_by_key(df, key, value, out, overflow)
    return top_k(sums, [F.col(out).desc_nulls_last(), F.col(key).asc_nulls_last()], k)


def tcp_only(df: DataFrame, protocol: str = "protocol") -> DataFrame:
    """Keep exactly the spellings ``tcp`` and ``TCP`` (``Tcp`` is rejected)."""
    return df.filter(F.col(protocol).isin(*TCP_SPELLINGS))


def trim_subnets(df: DataFrame, cols: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Replace each IP column by its prefix without the last dotted part (NULL when no dot)."""
    return df.select(*(keep or []), *[drop_last_component(src).alias(dst) for src, dst in cols.items()])


def distinct_count_by_key(df: DataFrame, key: str, value: str, out: str = "n_distinct",
                          approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct non-NULL values per key (NULL keys form one group).

    ``approximate`` uses HyperLogLog++ (``approx_count_distinct``): one pass, fixed-size
    sketches per key instead of the exact two-level (key, value) aggregate.
    """
    agg = F.approx_count_distinct(value, rsd) if approximate else F.countDistinct(value)
    return df.groupBy(key).agg(agg.alias(out))


def distinct_count_topk(df: DataFrame, key: str, value: str, k: int = 10, out: str = "n_distinct",
                        approximate: bool = False) -> DataFrame:
    counts = distinct_count_by_key(df, key, value, out, approximate)
    return top_k(counts, [F.col(out).desc(), F.col(key).asc_nulls_last()], k)


def source_destination_topk(events: DataFrame, k: int = 10) -> DataFrame:
    """TCP events -> subnets -> distinct destination subnets per source subnet -> top ``k``."""
    trimmed = trim_subnets(tcp_only(events), {"source_ip": "source_subnet", "destination_ip": "destination_subnet"})
    return distinct_count_topk(trimmed, "source_subnet", "destination_subnet", k, out="n_destinations")


def blocked_verdicts(verdicts: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Verdicts whose action is ``Blocked`` (exact, or ignoring case)."""
    action = F.col("action")
    cond = (action == BLOCKED) if case_sensitive else (F.lower(action) == BLOCKED.lower())
    return verdicts.filter(cond)


def firewall_log(trace: DataFrame, verdicts: DataFrame, case_sensitive: bool = False,
                 sort: bool = True, hot_rows: int | None = None) -> DataFrame:
    """Trace records joined with blocking verdicts on ``connection_id``, ordered by time.

    The action filter runs before the join (on the verdict side). Inner join: NULL ids never
    match and duplicate ids multiply. The trace is read once, and the adaptive skew join splits the
    partitions of hot connection ids; where it is off, ``hot_rows`` spreads ids with more trace rows
    than that over many tasks, which costs a second reading (``joins.salted_join``).
    """
    blocked = blocked_verdicts(verdicts, case_sensitive).select("connection_id", "action")
    records = trace.select("time", "connection_id", "source_ip", "destination_ip")
    joined = records.join(blocked, "connection_id") if hot_rows is None else salted_join(records, blocked, "connection_id", hot_rows=hot_rows)
    log = joined.select("time", "connection_id", "source_ip", "destination_ip", "action")
    return log.orderBy("time", "connection_id", "source_ip", "destination_ip") if sort else log


def blocked_count_by_source(log: DataFrame, sort: bool = True) -> DataFrame:
    """``COUNT(source_ip)`` per source IP of the firewall log, most blocked first."""
    counts = log.groupBy("source_ip").agg(F.count("source_ip").alias("num_blocks"))
    return counts.orderBy(F.col("num_blocks").desc(), F.col("source_ip").asc_nulls_last()) if sort else counts


def top_item_per_group(df: DataFrame, group: str, item: str, score: str, sort: bool = True) -> DataFrame:
    """Per group: row count, best score, and the item with the best score.

    Ties on score go to the smallest item (deterministic, unlike arrival order); NULL scores
    rank last. One aggregate with partial aggregation: no per-group collection.
    """
    s = F.col(score)
    # The smallest long has no negative of its own type.
    wide = s.cast("decimal(20,0)") if df.schema[score].dataType.simpleString() in INTEGRAL else s
    best_key = F.struct(s.isNull().alias("missing"), (-wide).alias("neg"), F.col(item).alias("item"))
    out = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min_by(F.col(item), best_key).alias("top_item"),
        F.max(s).alias("top_score"),
    )
    return out.orderBy(F.col("n_items").desc(), F.col(group).asc_nulls_last()) if sort else out
