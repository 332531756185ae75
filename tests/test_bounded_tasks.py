"""What one task holds or reads doesn't grow with the table: bigram combiner, text files, micro-batches of placed lines."""

import os
import random
from collections import Counter

from quarry.functions.text import space_token_count, space_tokens
from quarry.operators import counting
from quarry.plans import inputs
from quarry.streaming import stateful_windows as sw
from quarry.streaming import text_stream


def test_bigrams_are_counted_in_bounded_stretches(spark):
    r = random.Random(3)
    lines = [" ".join(r.choice(["a", "b.", "c", "1", "d!"]) for _ in range(r.randrange(9))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    parts = counting.partial_bigram_counts(df, held=3).collect()
    total = Counter()
    for p in parts:
        total[p.w1, p.w2] += p.n
    want = Counter()
    for line in lines:
        before = None
        for token in (line or "").split():
            word = "" if token == "1" else token[0]  # a closing mark is part of its word
            if word:
                want[before, word] += before is not None
                before = word
    want = Counter({pair: n for pair, n in want.items() if n})
    assert total == want
    assert len(parts) > len(total)
    assert {(x.w1, x.w2): x.n for x in counting.bigram_count(df, num_partitions=5).collect()} == total
    plan = counting.bigram_count(df)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("Exchange"):]
    assert "HashAggregate" not in scan  # none before the exchange: it would hold all the bigrams of a task


def test_a_table_of_many_pieces_gets_more_partitions(spark, tmp_path, monkeypatch):
    spark.range(2000).selectExpr("id as doc_id", "cast(id as string) as text").write.parquet(str(tmp_path / "documents.parquet"))
    assert inputs.pieces(spark, str(tmp_path), "documents") is None
    monkeypatch.setattr(inputs, "TEXT_FILE_BYTES", 500)
    folder = inputs.document_files(spark, str(tmp_path), str(tmp_path / "files"))
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    assert len(names) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [line for n in names for line in open(f"{folder}/{n}").read().split()] == [str(k) for k in range(2000)]


def test_placed_lines_come_in_micro_batches(spark, tmp_path):
    files, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    os.makedirs(files)
    for k in range(4):
        with open(f"{files}/{k}.txt", "w") as f:
            f.write("x y\n" * 5)
        os.utime(f"{files}/{k}.txt", (1_000_000 + 60 * k,) * 2)
    got = text_stream.advance(spark, files, folder, space_token_count("value"),
                              lambda lines: sw.word_window_topk_stateful(lines, "position", space_tokens("value"), 4, 1, shards=2), max_files=1)
    assert got.count() == 10
    commits = [n for n in os.listdir(f"{folder}/out-state/commits") if n.isdigit()]
    assert len(commits) >= 4
