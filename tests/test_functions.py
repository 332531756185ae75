"""Scalar semantics: Java split rules, bigram rules, IP trim, first-character buckets, parsers."""

from pyspark.sql import functions as F

from conftest import lines_df
from quarry.functions import text as T
from quarry.operators import counting, graph, relational
from quarry.sources import text as src


def test_java_split_on_space(spark):
    df = lines_df(spark, ["a b ", "", " ", " a  b"])
    got = [r[0] for r in df.select(T.space_tokens("value")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a", "", "b"]]


def test_whitespace_words_keep_leading_empty(spark):
    df = lines_df(spark, ["  x\ty  ", "\u000bz"])
    got = [r[0] for r in df.select(T.whitespace_words("value")).collect()]
    assert got == [["", "x", "y"], ["", "z"]]


def test_text_lines(spark):
    df = lines_df(spark, ["a\n\nb\n", "", "\n", "x\r\ny\rz"])
    got = [r[0] for r in df.select(T.text_lines("value")).collect()]
    assert got == [["a", "", "b"], [], [""], ["x", "y", "z"]]


def test_bigram_rules(spark):
    df = lines_df(spark, ["Hello , World . Foo dog. Bar 42 baz"])
    got = [(r.w1, r.w2) for r in counting.bigrams_of_lines(df).collect()]
    assert got == [("hello", "world"), ("foo", "dog"), ("dog", "bar"), ("bar", "baz")]


def test_lower_word_tokens(spark):
    df = lines_df(spark, ["It's  Über-cool, 42_x!"])
    got = df.select(T.lower_word_tokens("value")).first()[0]
    assert got == ["it", "s", "ber", "cool", "42_x"]


def test_key_value_split(spark):
    df = lines_df(spark, ["k\tv\tw", "nokey"])
    got = [tuple(r) for r in df.select(*src.split_key_value("value")).collect()]
    assert got == [("k", "v\tw"), ("nokey", "")]


def test_subnet_trim(spark):
    df = lines_df(spark, ["192.168.1.5.80", "nodot"])
    got = [r[0] for r in df.select(T.drop_last_component("value")).collect()]
    assert got == ["192.168.1.5", None]


def test_first_char_bucket(spark):
    keys = ["6", "7", "A", "Z", "a", "z", ":", "`", "{", ""]
    df = lines_df(spark, keys)
    got = [r[0] for r in df.select(T.first_char_bucket("value", 10)).collect()]
    assert got == [0, 1, 1, 5, 5, 9, 1, 5, 9, 0]


def test_edge_parsing(spark):
    df = lines_df(spark, ["1\t2", "1", "x\t2", "1\t2\t3", " 1\t2", "1\t2\t", "99999999999999999999\t1"])
    got = [(r.src, r.dst) for r in src.parse_edges(df).collect()]
    assert got == [(1, 2), (1, 2)]


def test_triangles_small_graph(spark):
    edges = ["1\t2", "1\t3", "1\t4", "2\t3", "2\t4", "3\t4", "2\t1", "1\t2", "3\t3"]
    und = graph.simple_undirected(src.parse_edges(lines_df(spark, edges)))
    assert graph.triangle_count(und).first()[0] == 4
    per = {r.vertex: r.n_triangles for r in graph.triangles_per_vertex(und).collect()}
    assert per == {1: 3, 2: 1}
    wedges = {r.center: r.n_wedges for r in graph.ordered_wedge_counts(und).collect()}
    assert wedges == {2: 2, 3: 2}


def test_empty_graph_gives_zero(spark):
    und = graph.simple_undirected(src.parse_edges(lines_df(spark, ["1\t2", "3\t4"])))
    assert graph.triangle_count(und).first()[0] == 0


def test_protocol_filter(spark):
    df = spark.createDataFrame([(p,) for p in ["tcp", "TCP", "Tcp", "udp"]], "protocol string")
    assert [r[0] for r in relational.tcp_only(df).collect()] == ["tcp", "TCP"]


def test_action_filter(spark):
    df = spark.createDataFrame([(1, a) for a in ["Blocked", "blocked", "Allowed"]], "connection_id int, action string")
    assert relational.blocked_verdicts(df).count() == 2
    assert relational.blocked_verdicts(df, case_sensitive=True).count() == 1


def test_distinct_count_ignores_null(spark):
    df = spark.createDataFrame([("g", "x"), ("g", "x"), ("g", "y"), ("g", None)], "k string, v string")
    assert relational.distinct_count_by_key(df, "k", "v").first()["n_distinct"] == 2


def test_argmax_tie_takes_smaller_name(spark):
    df = spark.createDataFrame([("zeta", "py", 5), ("alpha", "py", 5), ("mid", "py", 3)],
                               "name string, language string, stars int")
    row = relational.top_item_per_group(df, "language", "name", "stars").first()
    assert (row.n_items, row.top_item, row.top_score) == (3, "alpha", 5)


def test_adjacency_chunks_bounded(spark):
    sym = spark.createDataFrame([(0, d) for d in range(10)], "src long, dst long")
    rows = graph.adjacency_chunks(sym, chunk=4).orderBy("chunk").collect()
    assert [r.neighbors for r in rows] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]


def test_positional_parse_pig_nulls(spark):
    df = lines_df(spark, ["1\tx\t3", "7"])
    out = src.parse_delimited(df, "\t", [("a", "int"), ("b", "int"), ("c", "long")]).collect()
    assert [tuple(r) for r in out] == [(1, None, 3), (7, None, None)]
    assert F is not None


def test_triangle_blocks_split_hot_vertices(spark):
    """Tiny blocks force many blocks per vertex; the count must not change."""
    import itertools

    n = 9
    lines = [f"{a}\t{b}" for a, b in itertools.combinations(range(n), 2)]
    und = graph.simple_undirected(src.parse_edges(lines_df(spark, lines)))
    assert graph.triangles(und, block=2).count() == 84  # C(9, 3)
    assert graph.triangles(und, block=1000).count() == 84


def test_cheap_counts_equal_array_sizes(spark):
    vals = ["", " ", "a", "a b ", " a  b", "x y z", "It's  Über-cool, 42_x!", "   ", "a   "]
    df = lines_df(spark, vals)
    rows = df.select(F.size(T.space_tokens("value")), T.space_token_count("value"),
                     F.size(T.lower_word_tokens("value")), T.lower_word_count("value")).collect()
    for r in rows:
        assert r[0] == r[1] and r[2] == r[3]


def test_word_classification_java_rules(spark):
    toks = ["dog.", "42", ",", "", "été", "a\u2028b", "x\u0085", "Ab-c!", "?"]
    df = lines_df(spark, toks)
    got = [r[0] for r in df.select(T.classify_token("value")).collect()]
    assert got == ["dog", None, None, None, "t", None, None, "abc", "|"]  # U+2028 is not matched by "."
    anchored = [r[0] for r in df.select(F.col("value").rlike(T.WORD_TOKEN)).collect()]
    assert anchored == [r[0] for r in df.select(T.is_word("value")).collect()]


def test_salted_join_equals_plain_join(spark):
    from quarry.operators.joins import salted_join

    trace = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("connection_id"),
        F.col("id").cast("string").alias("time"), F.lit("10.0.0.1.5").alias("source_ip"),
        F.lit("10.0.0.2.80").alias("destination_ip"))
    verdicts = spark.createDataFrame([(7, "Blocked"), (7, "blocked"), (3, "Blocked"), (99, "Blocked")],
                                     "connection_id int, action string")
    plain = sorted(map(tuple, relational.firewall_log(trace, verdicts, sort=False).collect()))
    salted = sorted(map(tuple, relational.firewall_log(trace, verdicts, sort=False, hot_rows=100).collect()))
    assert plain == salted and len(plain) > 2000
    left = salted_join(trace, verdicts, "connection_id", "left", hot_rows=100, salts=8)
    assert left.count() == trace.join(verdicts, "connection_id", "left").count()
