"""Text files of our own, with odd line ends and blanks, and results worked out by hand."""

import os

import pytest

from quarry.functions.text import lower_word_count, lower_word_tokens, space_token_count, space_tokens
from quarry.operators import count_windows, counting, graph, relational
from quarry.sources import text as src

#: CR CR LF ends, a blank line, double and trailing blanks, a leading blank.
POEM = "I like words.\r\r\nLike  words like I do \r\n\r\n like WORDS, 2 words!\nEnd"
KEYS = ["_file", "_split", "_row"]


@pytest.fixture
def poem(tmp_path):
    path = tmp_path / "poem.txt"
    path.write_bytes(POEM.encode())
    return str(path)


def test_lines(spark, poem):
    # CR, LF and CR LF each end a line: the second CR of CR CR LF ends an empty one
    got = [r.value for r in src.read_ordered_lines(spark, poem).orderBy(*KEYS).collect()]
    assert got == ["I like words.", "", "Like  words like I do ", "", " like WORDS, 2 words!", "End"]


def test_a_directory_is_read_file_by_file(spark, tmp_path):
    for name, text in (("b.txt", "3\n4\n"), ("a.txt", "1\n2\n"), ("c.txt", "5")):
        (tmp_path / name).write_text(text)
    assert [r.value for r in src.read_ordered_lines(spark, str(tmp_path)).orderBy(*KEYS).collect()] == list("12345")
    assert src.read_lines(spark, str(tmp_path)).count() == 5


def test_word_count(spark, poem):
    counts = {r.word: r.n for r in counting.word_count(src.read_lines(spark, poem)).collect()}
    # a leading blank gives one empty word, and so does each empty line
    assert counts == {"I": 2, "like": 3, "words.": 1, "": 3, "Like": 1, "words": 1, "do": 1, "WORDS,": 1, "2": 1, "words!": 1, "End": 1}
    top = [(r.word, r.n) for r in counting.word_count_sorted(src.read_lines(spark, poem)).collect()]
    assert [n for _, n in top] == sorted((n for _, n in top), reverse=True) and top[0][1] == 3


def test_bigrams_stay_within_lines(spark, poem):
    counts = {(r.w1, r.w2): r.n for r in counting.bigram_count(src.read_lines(spark, poem)).collect()}
    assert counts[("i", "like")] == 1 and counts[("like", "words")] == 3 and counts[("words", "like")] == 1
    assert ("do", "like") not in counts


def test_word_windows_over_lines(spark, poem):
    lines = src.read_ordered_lines(spark, poem)
    top = count_windows.word_window_topk(lines, KEYS, lower_word_tokens("value"), lower_word_count("value"), 4, 2)
    got = [(r.window_id, r.rank, r.word, r.n) for r in top.orderBy("window_id", "rank").collect()]
    # i like words like | words like i do | like words 2 words | (end: not full)
    assert got == [(0, 1, "like", 2), (0, 2, "i", 1), (1, 1, "do", 1), (1, 2, "i", 1), (2, 1, "words", 2), (2, 2, "2", 1)]


def test_bigram_windows_over_lines(spark, poem):
    lines = src.read_ordered_lines(spark, poem)
    top = count_windows.bigram_window_topk(lines, KEYS, space_tokens("value"), space_token_count("value"), 5, 3)
    got = sorted((r.window_id, r.w1, r.w2, r.n) for r in top.collect())
    # tokens: I like words. '' Like | '' words like I do | '' '' like WORDS, 2 | (words! End: not full)
    assert got == [(0, "i", "like", 1), (0, "like", "words", 1), (0, "words", "like", 1), (1, "i", "do", 1), (1, "like", "i", 1), (1, "words", "like", 1), (2, "like", "words", 1)]


def test_too_short_for_a_window(spark, poem):
    lines = src.read_ordered_lines(spark, poem)
    assert count_windows.word_window_topk(lines, KEYS, lower_word_tokens("value"), None, 1000, 10).count() == 0


def test_key_values(spark, tmp_path):
    (tmp_path / "kv").write_text("a\tb\tc\nalone\n\tno key\n\n")
    assert sorted(tuple(r) for r in src.read_key_values(spark, str(tmp_path)).collect()) == [("", ""), ("", "no key"), ("a", "b\tc"), ("alone", "")]


def test_edges(spark, tmp_path):
    (tmp_path / "edges").write_text("1\t2\n2\t3\t\n1\t3\n 1\t4\nx\t5\n5\t6\t7\n3\t1\n4\t4\n")
    edges = src.read_edges(spark, str(tmp_path))
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (1, 3), (2, 3), (3, 1), (4, 4)]
    assert graph.triangle_count(graph.simple_undirected(edges)).first()[0] == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fields_fail_under_any_session_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("-5 Blocked",)], "value string")
        assert tuple(src.parse_verdicts(good).first()) == (-5, "Blocked")
        for line in ("x Blocked", "\t5 Blocked", "5.0 Blocked", "3000000000 Blocked", "5", ""):
            with pytest.raises(Exception, match="bad "):
                src.parse_verdicts(spark.createDataFrame([(line,)], "value string")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_fields_follow_pig(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = {"5": 5, "5.7": 5, "-5.7": -5, "": None, "x": None, "\t5": 5, "1e3": 1000, "3000000000": None, "-3000000000": -(2**31), "+7": 7, ".9": 0}
        lines = spark.createDataFrame([(k, f"{k} a") for k in cases], "k string, value string")
        got = {r.k: (r.connection_id, r.action) for r in src.parse_verdicts(lines, strict=False, keep=["k"]).collect()}
        assert got == {k: (v, "a") for k, v in cases.items()}
        empty = spark.createDataFrame([("t 1  > d",)], "value string")
        assert src.parse_trace(empty, strict=False).first().source_ip is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_verdicts_by_case(spark):
    v = src.parse_verdicts(spark.createDataFrame([("1 Blocked ",), ("2 blocked",), ("3 Allowed",)], "value string"))
    assert relational.blocked_verdicts(v, case_sensitive=True).count() == 1 and relational.blocked_verdicts(v).count() == 2


def test_sorted_outputs_are_in_order_over_many_partitions(spark):
    lines = spark.createDataFrame([(f"w{i % 37} w{i % 11}",) for i in range(3000)], "value string").repartition(7)
    counts = [(-r.n, r.word) for r in counting.word_count_sorted(lines).collect()]
    assert counts == sorted(counts)
    trace = spark.createDataFrame([(f"{(i * 7919) % 997:04d}", i % 50, f"s{i % 13}", "d") for i in range(2000)], "time string, connection_id int, source_ip string, destination_ip string").repartition(9)
    verdicts = spark.createDataFrame([(i, "Blocked") for i in range(0, 50, 2)], "connection_id int, action string")
    log = relational.firewall_log(trace, verdicts, hot_rows=10)
    got = [tuple(r)[:4] for r in log.collect()]
    assert got == sorted(got) and len(got) == 1000
    blocks = [(-r.num_blocks, r.source_ip) for r in relational.blocked_count_by_source(log).collect()]
    assert blocks == sorted(blocks)
    repos = spark.createDataFrame([(f"l{i % 9}", f"r{i}", i % 5) for i in range(400)], "language string, name string, stars int").repartition(5)
    top = [(-r.n_items, r.language) for r in relational.top_item_per_group(repos, "language", "name", "stars").collect()]
    assert top == sorted(top)


def test_refusal_and_file_counts(spark, tmp_path):
    from quarry.sinks import writers

    df = spark.range(100).selectExpr("cast(id as string) as v").repartition(6)
    out = str(tmp_path / "out")
    writers.write_tab_text(df, out, num_files=3)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 3
    with pytest.raises(Exception, match="already exists"):
        writers.write_tuple_text(df, out)
    writers.write_tab_text(df.limit(1), out, mode="overwrite")
    assert spark.read.text(out).count() == 1
