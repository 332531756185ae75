"""From raw documents to packed training sequences: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and gives documents with their columns, but the last one, which gives the pieces
of the packed sequences. ``run`` writes what a stage keeps to the shared checkpoint folder and the next one reads that.
Documents may have more columns, of any names, which are kept as they are; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, linededup, packing, quality, simhash
from quarry.llm.components import materialised

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed base rules and the adaptive thresholds of their language and source.

    Null and wordless texts fail; a null language or source is a group of its own; repeated rows are each judged.
    """
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match earlier ones; those that lose all their words go.

    A column ``n_chars``, if there is one, follows the text. Null and wordless texts stay as they are; a null id comes after
    all others; rows equal in id remove lines of one another only by line number.
    """
    kept = linededup.deduplicate(docs, drop_emptied=True)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: three-word shingles, at most three of 64 bits apart.

    The smallest id stays (nulls last), of equal ids the smallest hash of the text, of rows that repeat both one. Null and
    wordless texts have fingerprint zero and are a group.
    """
    return simhash.keep_one_of_each_group(docs, shingle_words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item; null and wordless texts stay, repeated rows go or stay together."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens; a null text is empty, repeated rows are each packed."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Line sets by similarity, fingerprints and token ids are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
