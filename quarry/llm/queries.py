"""Queries over the given tables, one for each operator: (spark, sf_dir) -> DataFrame; and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, langid, linededup, packing, phrases, pii, quality, secrets, simhash, substring, suffix, urls, whitening
from quarry.llm.oracles import ORACLES  # noqa: F401

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.deduplicate(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(_documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start", "n_words")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(_documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), TOKENIZER)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontaminate": op4_decontaminate,
    "op5_pii": op5_pii,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_url_filter": op11_url_filter,
    "op12_phrases": op12_phrases,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}
