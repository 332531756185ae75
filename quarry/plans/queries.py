"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator family.

Each reads whole driver tables (or inputs Spark derives from them, see ``plans.inputs``).
Order-bearing results expose order as a ``rank`` column; plain sorted outputs are returned as
sorted DataFrames (``orderBy``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import lower_word_count, lower_word_tokens, space_token_count, space_tokens, text_lines
from quarry.operators import count_windows, counting, distinct_bitmaps, graph, graph_increments, graph_sampling, kept_counts, ordering, relational
from quarry.operators.topk import top_k
from quarry.plans import inputs
from quarry.session import scratch_path
from quarry.sources import rejects
from quarry.sources import text as src
from quarry.streaming import firewall, stateful_windows, text_stream

K = 10
WINDOW = 1000
SORT_BUCKETS = 10
#: Two-paths that the sampling query draws from all.
DRAWS = 5000
#: Text files that a micro-batch takes.
FILES_A_BATCH = 4


# --- words and bigrams ------------------------------------------------------------------------

def word_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.word_count_sorted(inputs.document_lines(spark, sf_dir))


def bigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.bigram_count(inputs.document_lines(spark, sf_dir), num_partitions=inputs.pieces(spark, sf_dir, "documents"))


def bigram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.bigram_topk(inputs.document_lines(spark, sf_dir), K, num_partitions=inputs.pieces(spark, sf_dir, "documents")).select("rank", "w1", "w2", "n")


def kept_bigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of three batches, the second of which comes twice, kept in one table; the rows of ``bigram_count``."""
    folder, lines = scratch_path(spark, "kept-counts"), inputs.document_lines(spark, sf_dir)
    for batch in (0, 1, 1, 2):
        kept_counts.add(counting.bigram_count(lines.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == batch)), folder, batch)
    return kept_counts.total(spark, folder, ["w1", "w2"])


def bigram_topk_by_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.bigram_topk_by_summaries(inputs.document_lines(spark, sf_dir), K).select("rank", "w1", "w2", "n")


def word_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_windows.word_window_topk(docs, "doc_id", lower_word_tokens("text"), lower_word_count("text"), WINDOW, K)


def bigram_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lower-casing the whole text equals lower-casing each token: it never adds or removes the
    # blanks and line breaks that delimit tokens.
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    lines = text_lines("text")
    tokens = F.flatten(F.transform(lines, lambda line: space_tokens(line)))
    n_tokens = F.aggregate(lines, F.lit(0).cast("long"), lambda acc, line: acc + space_token_count(line))
    return count_windows.bigram_window_topk(docs, "doc_id", tokens, n_tokens, WINDOW, K, lowercase=False)


# --- streams ----------------------------------------------------------------------------------

def _stream_session(spark: SparkSession) -> SparkSession:
    """A child session (same SparkContext, own SQL conf) whose shuffle-partition count sets the
    number of state partitions of the streams started from it (fixed at a stream's first start).
    One per core suits these bounded runs; the caller's session conf is left untouched."""
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return child


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(inputs.table_path(sf_dir, "events")).schema
    # A file stream watches a directory; the glob picks the table's files in it.
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


def stream_word_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream; the event id is the position; one appended report per full window."""
    spark = _stream_session(spark)
    items = _event_stream(spark, sf_dir).select(F.col("event_id").alias("ordinal"),
                                               F.expr(inputs.STREAM_WORD_SQL).alias("word"))
    return stateful_windows.run_to_files(
        stateful_windows.word_window_topk_stateful(items, window_size=WINDOW, k=K), spark, "stream-words")


def stream_bigram_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = _stream_session(spark)
    items = _event_stream(spark, sf_dir).select(F.col("event_id").alias("ordinal"),
                                               F.expr(inputs.STREAM_TOKEN_SQL).alias("token"))
    return stateful_windows.run_to_files(
        stateful_windows.bigram_window_topk_stateful(items, window_size=WINDOW, k=K), spark, "stream-bigrams")


def stream_text_word_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files as a stream that assigns the words' positions itself; the windows of ``word_window_topk``."""
    spark = _stream_session(spark)
    files = inputs.document_files(spark, sf_dir, scratch_path(spark, "text-files"))

    def windows(lines: DataFrame) -> DataFrame:
        return stateful_windows.word_window_topk_stateful(lines, "position", lower_word_tokens("value"), WINDOW, K)

    return text_stream.advance(spark, files, scratch_path(spark, "text-words"), lower_word_count("value"), windows, FILES_A_BATCH)


def stream_text_bigram_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = _stream_session(spark)
    files = inputs.document_files(spark, sf_dir, scratch_path(spark, "text-files"))

    def windows(lines: DataFrame) -> DataFrame:
        return stateful_windows.bigram_window_topk_stateful(lines, "position", space_tokens("value"), WINDOW, K)

    return text_stream.advance(spark, files, scratch_path(spark, "text-bigrams"), space_token_count("value"), windows, FILES_A_BATCH)


def _firewall_streams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    spark = _stream_session(spark)
    trace = inputs.text_files(inputs.trace_lines(spark, sf_dir), ["value"], scratch_path(spark, "trace-files"))
    verdicts = inputs.text_files(inputs.verdict_lines(spark, sf_dir), ["value"], scratch_path(spark, "verdict-files"))
    return firewall.advance(spark, trace, verdicts, scratch_path(spark, "firewall"), FILES_A_BATCH)


def stream_firewall_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace and verdict files joined as they arrive; the rows of ``firewall_log``."""
    return _firewall_streams(spark, sf_dir)[0]


def stream_blocked_count_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firewall_streams(spark, sf_dir)[1]


# --- scans and parsers ------------------------------------------------------------------------

def kv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.kv_lines(spark, sf_dir)
    return lines.select("line_id", *src.split_key_value("value"))


def delimited_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_delimited(inputs.lineitem_tsv_lines(spark, sf_dir), "\t", inputs.LINEITEM_TSV_SCHEMA)


def positional_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_network_events(inputs.trace_lines(spark, sf_dir))


def lenient_trace_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_trace(inputs.noisy_trace_lines(spark, sf_dir), strict=False, keep=["event_id"])


# --- ordering ---------------------------------------------------------------------------------

def total_order_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = kv_parse(spark, sf_dir).select("key", "value")
    return ordering.with_global_rank(records, ["key", "value"])


def first_char_bucket_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("key"))
    out = ordering.first_char_bucket_sort(conv, "key", SORT_BUCKETS, tie_break=["conv_id", "turn"])
    return out.select("conv_id", "turn", "bucket", "rank_in_bucket")


# --- relational -------------------------------------------------------------------------------

def sum_by_key_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = delimited_typed_scan(spark, sf_dir)
    top = relational.sum_by_key_topk(typed, "l_partkey", "l_quantity", K, out="total_quantity")
    return top.select("l_partkey", "total_quantity", "rank")


def tcp_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.tcp_only(positional_project(spark, sf_dir))


def ip_prefix_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.trim_subnets(tcp_filter(spark, sf_dir),
                                   {"source_ip": "source_subnet", "destination_ip": "destination_subnet"})


def distinct_count_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = relational.source_destination_topk(positional_project(spark, sf_dir), K)
    return top.select("source_subnet", "n_destinations", "rank")


def distinct_count_topk_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``distinct_count_topk`` from bitmaps per day, of two batches, the first of which comes twice."""
    folder = scratch_path(spark, "distinct-days")
    trace = src.parse_network_events(inputs.trace_lines(spark, sf_dir, keep=["event_id", "ts"]), keep=["event_id", "ts"])
    subnets = relational.trim_subnets(relational.tcp_only(trace), {"source_ip": "key", "destination_ip": "value"}, keep=["event_id", "ts"])
    for batch in (0, 0, 1):
        own = subnets.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == batch)
        distinct_bitmaps.add(own.select(F.to_date("ts").alias("day"), "key", "value"), folder, batch)
    counts = distinct_bitmaps.distinct_counts(spark, folder).select(F.col("key").alias("source_subnet"), F.col("n_distinct").alias("n_destinations"))
    return top_k(counts, [F.col("n_destinations").desc(), F.col("source_subnet").asc_nulls_last()], K).select("source_subnet", "n_destinations", "rank")


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_trace(inputs.trace_lines(spark, sf_dir))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_verdicts(inputs.verdict_lines(spark, sf_dir))


def firewall_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.firewall_log(_trace(spark, sf_dir), _verdicts(spark, sf_dir), case_sensitive=False)


def firewall_log_case_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.firewall_log(_trace(spark, sf_dir), _verdicts(spark, sf_dir), case_sensitive=True)


def blocked_count_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = relational.firewall_log(_trace(spark, sf_dir), _verdicts(spark, sf_dir), sort=False)
    return relational.blocked_count_by_source(log)


def top_item_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = src.parse_repositories(inputs.repository_lines(spark, sf_dir))
    out = relational.top_item_per_group(repos, "language", "name", "stars")
    return out.select("language", F.col("n_items").alias("n_repos"), F.col("top_item").alias("top_repo"),
                      F.col("top_score").alias("top_stars"))


# --- graph ------------------------------------------------------------------------------------

def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_edges(inputs.edge_lines(spark, sf_dir))


def edge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_edges(inputs.edge_lines(spark, sf_dir, noisy=True))


def edge_parse_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the noisy edge list, with its ids or the reason why it has none, written once."""
    folder = scratch_path(spark, "edge-rejects")
    rejects.write_checked(rejects.edges_with_reason(inputs.edge_lines(spark, sf_dir, noisy=True)), folder, most_rejects=0.9)
    good = rejects.records(spark, folder).select("src", "dst", F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
    none = F.lit(None).cast("long")
    return good.unionAll(rejects.rejects(spark, folder).select(none.alias("src"), none.alias("dst"), "line", "reason"))


def edge_symmetrize_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.symmetrize_distinct(_edges(spark, sf_dir))


def adjacency_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = graph.adjacency_chunks(graph.symmetrize_distinct(_edges(spark, sf_dir)))
    return chunks.select("vertex", "chunk", F.array_join("neighbors", ",").alias("neighbors"))


def ordered_wedges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ordered_wedge_counts(graph.simple_undirected(_edges(spark, sf_dir)))


def triangles_per_vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triangles_per_vertex(graph.simple_undirected(_edges(spark, sf_dir)))


def triangle_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triangle_count(graph.simple_undirected(_edges(spark, sf_dir)))


def sampled_two_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_sampling.sample_two_paths(graph.simple_undirected(_edges(spark, sf_dir)), DRAWS)


def arriving_triangle_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triangles of three batches of edges, counted as they come; the row of ``triangle_count``."""
    folder = scratch_path(spark, "arriving-edges")
    edges = src.parse_edges(inputs.edge_lines(spark, sf_dir, keep=["l_orderkey"]), keep=["l_orderkey"])
    for batch in range(3):
        graph_increments.add_edges(edges.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(3)) == batch), folder, batch)
    return graph_increments.triangle_count(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count_sorted": word_count_sorted,
    "bigram_count": bigram_count,
    "bigram_topk": bigram_topk,
    "bigram_topk_by_summaries": bigram_topk_by_summaries,
    "kept_bigram_count": kept_bigram_count,
    "word_window_topk": word_window_topk,
    "bigram_window_topk": bigram_window_topk,
    "stream_word_window_topk": stream_word_window_topk,
    "stream_bigram_window_topk": stream_bigram_window_topk,
    "stream_text_word_window_topk": stream_text_word_window_topk,
    "stream_text_bigram_window_topk": stream_text_bigram_window_topk,
    "stream_firewall_log": stream_firewall_log,
    "stream_blocked_count_by_source": stream_blocked_count_by_source,
    "kv_parse": kv_parse,
    "delimited_typed_scan": delimited_typed_scan,
    "positional_project": positional_project,
    "lenient_trace_scan": lenient_trace_scan,
    "total_order_sort": total_order_sort,
    "first_char_bucket_sort": first_char_bucket_sort,
    "sum_by_key_topk": sum_by_key_topk,
    "tcp_filter": tcp_filter,
    "ip_prefix_trim": ip_prefix_trim,
    "distinct_count_topk": distinct_count_topk,
    "distinct_count_topk_from_days": distinct_count_topk_from_days,
    "firewall_log": firewall_log,
    "firewall_log_case_sensitive": firewall_log_case_sensitive,
    "blocked_count_by_source": blocked_count_by_source,
    "top_item_per_group": top_item_per_group,
    "edge_parse": edge_parse,
    "edge_parse_with_rejects": edge_parse_with_rejects,
    "edge_symmetrize_distinct": edge_symmetrize_distinct,
    "adjacency_list": adjacency_list,
    "ordered_wedges": ordered_wedges,
    "triangles_per_vertex": triangles_per_vertex,
    "triangle_count": triangle_count,
    "sampled_two_paths": sampled_two_paths,
    "arriving_triangle_count": arriving_triangle_count,
}
