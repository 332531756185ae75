"""Inputs of the registered queries, derived by Spark from the driver tables.

The reference reads text files (corpora, traces, verdicts, edge lists, CSV). Here each such
input is derived from a driver table with column expressions, so it grows with the table. The
same derivations are spelled in DuckDB SQL in ``plans.oracles``; keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import text_lines

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, value)``: every line of every document (documents read as text files)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(text_lines("text")).alias("value"))


#: Bytes of a table's files for which a shuffle has a partition, if the session's setting gives fewer.
PIECE_BYTES = 16 << 20
#: The same for a text file that is written.
TEXT_FILE_BYTES = 64 << 20


def pieces(spark: SparkSession, sf_dir: str, name: str, piece: int = PIECE_BYTES) -> int | None:
    """The number of partitions for a shuffle of a whole table: None for the session's own, which is enough."""
    at = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
    size = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(at).getLength()
    wanted = -(-size // piece)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def text_files(lines: DataFrame, order: list[str], folder: str, num_files: int | None = None) -> str:
    """Lines (``value``) as text files under ``folder``, sorted by ``order``; modification times follow that order."""
    spark = lines.sparkSession
    by = order if num_files is None else [num_files, *order]
    lines.repartitionByRange(*by).sortWithinPartitions(*order).select("value").write.text(folder)
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    paths = sorted((f.getPath() for f in files.listStatus(at)), key=lambda p: p.getName())  # one for each write task
    for k, p in enumerate(p for p in paths if p.getName().startswith("part-")):
        files.setTimes(p, 1_000_000_000_000 + 1000 * k, -1)
    return folder


def document_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The documents' lines as text files, in document order."""
    docs = table(spark, sf_dir, "documents").filter("doc_id is not null")
    return text_files(docs.select("doc_id", F.posexplode(text_lines("text")).alias("line", "value")), ["doc_id", "line"], folder, pieces(spark, sf_dir, "documents", TEXT_FILE_BYTES))


# Trace lines: "time connection_id source_ip > destination_ip protocol", one per event.
TRACE_LINE_SQL = """concat_ws(' ',
    concat(lpad(cast(((event_id * 7919) % 86400) div 3600 as string), 2, '0'), ':',
           lpad(cast((((event_id * 7919) % 86400) div 60) % 60 as string), 2, '0'), ':',
           lpad(cast(((event_id * 7919) % 86400) % 60 as string), 2, '0')),
    cast(event_id as string),
    CASE WHEN event_type = 'error' AND user_id < 3 THEN concat('host', cast(user_id as string))
         ELSE concat_ws('.', '10', cast(user_id div 256 as string), cast(user_id % 256 as string),
                        cast(event_id % 4 as string), cast(1024 + (event_id * 13) % 977 as string)) END,
    '>',
    concat_ws('.', '172', '16', cast((event_id * 31) % 50 as string), cast((event_id * 17) % 7 as string),
              cast(80 + event_id % 3 as string)),
    CASE event_type WHEN 'click' THEN 'tcp' WHEN 'view' THEN 'TCP' WHEN 'purchase' THEN 'Tcp'
                    WHEN 'signup' THEN 'udp' ELSE 'tcp' END)"""

# Trace lines as they come: every seventh has an empty, decimal, blank-padded, wordy or too large id, or ends early.
NOISY_TRACE_LINE_SQL = """CASE cast(event_id % 7 as int)
    WHEN 0 THEN concat('10:00:00  10.0.0.1 > ', cast(event_id as string))
    WHEN 1 THEN concat('10:00:01 ', cast(event_id as string), '.7 10.0.0.1 > 10.0.0.2')
    WHEN 2 THEN concat('10:00:02 \\t', cast(event_id as string), ' 10.0.0.1 >  tcp')
    WHEN 3 THEN concat('10:00:03 -', cast(event_id as string), '.5e0')
    WHEN 4 THEN concat(' ', cast(3000000000 + event_id as string), ' 10.0.0.1 > 10.0.0.2 ')
    WHEN 5 THEN 'x y 10.0.0.1'
    ELSE concat('10:00:06 ', cast(event_id as string), ' 10.0.0.1 > 10.0.0.2 tcp') END"""

# Verdict lines: "connection_id action " (trailing blank as in the shipped sample).
VERDICT_LINE_SQL = """concat(cast(o_orderkey as string), ' ',
    CASE o_orderstatus WHEN 'F' THEN 'Blocked' WHEN 'P' THEN 'blocked' ELSE 'Allowed' END, ' ')"""

# Key/value lines: "priority<TAB>orderkey<TAB>status", or just the key for pending orders.
KV_LINE_SQL = """CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
    ELSE concat_ws('\\t', o_orderpriority, cast(o_orderkey as string), o_orderstatus) END"""

# Typed TAB lines of lineitem; line number 4 has a bad quantity, 7 is cut after three fields.
LINEITEM_TSV_SQL = """CASE WHEN l_linenumber = 7
    THEN concat_ws('\\t', cast(l_orderkey as string), cast(l_partkey as string), cast(l_suppkey as string))
    ELSE concat_ws('\\t', cast(l_orderkey as string), cast(l_partkey as string), cast(l_suppkey as string),
                   cast(l_linenumber as string),
                   CASE WHEN l_linenumber = 4 THEN 'n/a' ELSE cast(cast(floor(l_quantity) as bigint) as string) END,
                   l_returnflag, l_linestatus) END"""

LINEITEM_TSV_SCHEMA = [("l_orderkey", "long"), ("l_partkey", "long"), ("l_suppkey", "long"),
                       ("l_linenumber", "int"), ("l_quantity", "long"), ("l_returnflag", "string"),
                       ("l_linestatus", "string")]

# Repository CSV lines (13 fields): name, language, brand, key, 8 filler fields, stars.
REPOSITORY_LINE_SQL = """concat_ws(',', p_name, p_type, p_brand, cast(p_partkey as string),
    'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', cast(p_size as string))"""

# Edge lines "part<TAB>supplier" (one id space). The noisy variant adds malformed lines:
# line 2 trailing TAB (kept), 3 leading blank, 5 third field, 6 letter prefix (all dropped).
EDGE_LINE_SQL = "concat(cast(l_partkey as string), '\\t', cast(l_suppkey as string))"
NOISY_EDGE_LINE_SQL = """CASE l_linenumber
    WHEN 2 THEN concat(cast(l_partkey as string), '\\t', cast(l_suppkey as string), '\\t')
    WHEN 3 THEN concat(' ', cast(l_partkey as string), '\\t', cast(l_suppkey as string))
    WHEN 5 THEN concat(cast(l_partkey as string), '\\t', cast(l_suppkey as string), '\\t', cast(l_orderkey as string))
    WHEN 6 THEN concat('x', cast(l_partkey as string), '\\t', cast(l_suppkey as string))
    ELSE concat(cast(l_partkey as string), '\\t', cast(l_suppkey as string)) END"""


def trace_lines(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return table(spark, sf_dir, "events").select(*(keep or []), F.expr(TRACE_LINE_SQL).alias("value"))


def noisy_trace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.expr(NOISY_TRACE_LINE_SQL).alias("value"))


def verdict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.expr(VERDICT_LINE_SQL).alias("value"))


def kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line_id"),
                                                 F.expr(KV_LINE_SQL).alias("value"))


def lineitem_tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.expr(LINEITEM_TSV_SQL).alias("value"))


def repository_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.expr(REPOSITORY_LINE_SQL).alias("value"))


def edge_lines(spark: SparkSession, sf_dir: str, noisy: bool = False, keep: list[str] | None = None) -> DataFrame:
    expr = NOISY_EDGE_LINE_SQL if noisy else EDGE_LINE_SQL
    return table(spark, sf_dir, "lineitem").select(*(keep or []), F.expr(expr).alias("value"))


# Event streams: the event id is the stream position.
STREAM_WORD_SQL = "lower(concat(event_type, '_', cast(user_id as string)))"
STREAM_TOKEN_SQL = "CASE WHEN event_type = 'error' THEN '!' ELSE event_type END"
