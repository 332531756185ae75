"""The pipeline's stages against brute force, each on its own input, and run() as a whole."""

import collections

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import quality
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source"]


@pytest.fixture(scope="module")
def corpus(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    items = [(1, " ".join(rows[7][1].split()[3:25]))]
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def _after(rows, stage, items):
    if stage == 0:
        return [x for x, judged in zip(rows, brute.quality(rows, quality.RATES, quality.FENCE, quality.MIN_ROWS)) if judged[-1]]
    if stage == 1:
        cut = brute.line_dedup(rows)
        return [(x[0], c[3], *x[2:]) for x, c in zip(rows, cut) if not c[2] or c[2] < c[1]]
    if stage == 2:
        kept, seen = [], set()
        for x, (i, _, component) in zip(rows, brute.near_duplicates(rows)):
            if i == component and (component, x[1]) not in seen:
                seen.add((component, x[1]))
                kept.append(x)
        return kept
    return [x for x in rows if not brute.leaks([x], items)]


def test_run_is_the_stages_one_after_the_other(spark, corpus, rows):
    folder, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = rows
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        want = _after(want, k, items)
        assert docs.columns == [*COLUMNS, "n_chars"]
        assert collections.Counter(tuple(x)[:4] for x in docs.collect()) == collections.Counter(want), corpus_pipeline.STAGES[k][0]
        assert all(x.n_chars == len(x.text or "") for x in docs.collect())
    assert want and len(want) < len(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter(tuple(x)[:5] for x in got) == collections.Counter(brute.pieces(want, tokenizer))


def test_stages_take_an_empty_table(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_take_clashing_columns_and_no_n_chars(spark, corpus, docs):
    folder, _ = corpus
    table = docs.drop("n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, folder)
        assert out.columns == table.columns, name
        assert out.count() > 0
