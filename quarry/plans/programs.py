"""File-to-file entry points, one per analysis the reference ships (input paths -> output path).

Each composes the library's sources, operators and sinks and returns the result DataFrame after
writing it. Output text forms: tuple text ``(a,b,...)`` for the RDD-style programs, TAB text for
the MapReduce / Pig-style ones. Outputs are written by Spark's committers; ``mode`` chooses
replace (``overwrite``) or refuse (``errorifexists``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import (
    first_char_bucket,
    lower_word_count,
    lower_word_tokens,
    space_token_count,
    space_tokens,
)
from quarry.operators import count_windows, counting, graph, ordering, relational
from quarry.session import materialize
from quarry.sinks import writers
from quarry.sources import text as src

# Gazetteer layout (TAB-separated, 10 typed columns).
GAZETTEER_SCHEMA = [("usps", "string"), ("geoid", "long"), ("pop10", "int"), ("hu10", "int"),
                    ("aland", "long"), ("awater", "int"), ("aland_sqmi", "double"),
                    ("awater_sqmi", "double"), ("intptlat", "double"), ("intptlong", "double")]

_FILE_KEYS = ["_file", "_split", "_row"]


def bigram_top_k(spark: SparkSession, input_path: str, output_path: str, k: int = 10,
                 mode: str = "errorifexists") -> DataFrame:
    """Most frequent bigrams (inside lines): ``w1 w2<TAB>n`` lines, most frequent first."""
    top = counting.bigram_topk(src.read_lines(spark, input_path), k)
    out = top.select("rank", F.concat_ws(" ", "w1", "w2").alias("bigram"), "n")
    writers.write_tab_text(out, output_path, mode, num_files=1, order=["rank"], columns=["bigram", "n"])
    return top


def total_order_sort(spark: SparkSession, input_path: str, output_path: str, num_files: int | None = None,
                     mode: str = "overwrite") -> DataFrame:
    """Key/value text sorted by key (then value), in global order over the files (``num_files``, if given).

    Returns the lines as written, in the order of the files.
    """
    kv = ordering.sorted_by_range(src.read_key_values(spark, input_path), ["key", "value"], num_files)
    writers.write_tab_text(kv, output_path, mode)
    return src.read_key_values(spark, output_path)


def first_char_sort(spark: SparkSession, input_path: str, output_path: str, num_buckets: int = 10,
                    mode: str = "overwrite") -> DataFrame:
    """Key/value text sorted by key and routed by first character: directory ``bucket=i`` per
    bucket, files sorted and in range order inside it (a crowded bucket spreads over files)."""
    kv = src.read_key_values(spark, input_path).withColumn("bucket", first_char_bucket("key", num_buckets))
    shaped = ordering.sorted_by_range(kv, ["bucket", "key", "value"])
    shaped.select("bucket", F.concat_ws("\t", "key", "value").alias("value")).write.mode(mode) \
        .partitionBy("bucket").text(output_path)
    return src.read_lines(spark, output_path).select("bucket", *src.split_key_value("value"))


def land_area_top_k(spark: SparkSession, input_path: str, output_path: str, k: int = 10,
                    mode: str = "overwrite") -> DataFrame:
    """Top ``k`` states by total land area from the TAB gazetteer."""
    rows = src.read_delimited(spark, input_path, "\t", GAZETTEER_SCHEMA)
    top = relational.sum_by_key_topk(rows, "usps", "aland", k, out="total_land_area")
    writers.write_tab_text(top, output_path, mode, num_files=1, order=["rank"], columns=["usps", "total_land_area"])
    return top


def distinct_destinations_top_k(spark: SparkSession, input_path: str, output_path: str, k: int = 10,
                                mode: str = "overwrite") -> DataFrame:
    """Top ``k`` source subnets by distinct TCP destination subnets."""
    top = relational.source_destination_topk(src.read_network_events(spark, input_path), k)
    writers.write_tab_text(top, output_path, mode, num_files=1, order=["rank"],
                           columns=["source_subnet", "n_destinations"])
    return top


def firewall_log(spark: SparkSession, trace_path: str, block_path: str, log_output: str, counts_output: str,
                 case_sensitive: bool = False, strict: bool = True, tuple_text: bool = True,
                 mode: str = "overwrite") -> tuple[DataFrame, DataFrame]:
    """Blocked connections ordered by time, and blocked counts per source IP (most first).

    ``case_sensitive=True, strict=False, tuple_text=False`` is the Pig form (exact ``Blocked``,
    NULL on bad fields, TAB output); the defaults are the RDD form. The joined log is written once to the checkpoint
    folder, and both outputs read that.
    """
    trace = src.read_trace(spark, trace_path, strict=strict)
    verdicts = src.read_verdicts(spark, block_path, strict=strict)
    joined = materialize(relational.firewall_log(trace, verdicts, case_sensitive, sort=False), "firewall-log")
    log = joined.orderBy("time", "connection_id", "source_ip", "destination_ip")
    counts = relational.blocked_count_by_source(joined)
    write = writers.write_tuple_text if tuple_text else writers.write_tab_text
    write(log, log_output, mode)
    write(counts, counts_output, mode)
    return log, counts


def word_count_sorted(spark: SparkSession, input_path: str, output_path: str,
                      mode: str = "errorifexists") -> DataFrame:
    """``(count,word)`` tuple lines, most frequent first, files in global order."""
    counts = counting.word_count_sorted(src.read_lines(spark, input_path))
    writers.write_tuple_text(counts.select("n", "word"), output_path, mode)
    return counts


def top_languages(spark: SparkSession, input_path: str, output_path: str, naive_csv: bool = True,
                  mode: str = "overwrite") -> DataFrame:
    """Per language: repositories, most-starred repository and its stars, most repositories first."""
    repos = src.read_repositories(spark, input_path, naive=naive_csv)
    out = relational.top_item_per_group(repos, "language", "name", "stars")
    writers.write_tuple_text(out, output_path, mode)
    return out


def triangles(spark: SparkSession, input_path: str, output_path: str, sep: str = "\t",
              mode: str = "overwrite") -> DataFrame:
    """Number of triangles of the undirected graph in a TAB edge list (one line)."""
    count = graph.triangle_count(graph.simple_undirected(src.read_edges(spark, input_path, sep)))
    count.select(F.col("n_triangles").cast("string").alias("value")).write.mode(mode).text(output_path)
    return count


def word_window_top_k(spark: SparkSession, input_path: str, output_path: str, window: int = 1000,
                      k: int = 10, mode: str = "overwrite") -> DataFrame:
    """Top ``k`` words of every full window of ``window`` words, in file order."""
    lines = src.read_ordered_lines(spark, input_path)
    top = count_windows.word_window_topk(lines, _FILE_KEYS, lower_word_tokens("value"), lower_word_count("value"), window, k)
    writers.write_table(top, output_path, mode)
    return top


def bigram_window_top_k(spark: SparkSession, input_path: str, output_path: str, window: int = 1000,
                        k: int = 10, mode: str = "overwrite") -> DataFrame:
    """Top ``k`` bigrams of every full window of ``window`` raw tokens, in file order."""
    lines = src.read_ordered_lines(spark, input_path)
    top = count_windows.bigram_window_topk(lines, _FILE_KEYS, space_tokens("value"), space_token_count("value"), window, k)
    writers.write_table(top, output_path, mode)
    return top


__all__ = ["bigram_top_k", "total_order_sort", "first_char_sort", "land_area_top_k",
           "distinct_destinations_top_k", "firewall_log", "word_count_sorted", "top_languages",
           "triangles", "word_window_top_k", "bigram_window_top_k"]
