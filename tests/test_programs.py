"""File-to-file programs on the shipped samples and on small files made here."""

import os
import tempfile

from quarry.plans import programs


def _out(name):
    return os.path.join(tempfile.mkdtemp(prefix="quarry-prog-", dir="/tmp"), name)


def _text(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def _write(lines):
    path = _out("in.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_word_count_program(spark):
    out = _out("wc")
    programs.word_count_sorted(spark, _write(["a b a .", "b a  c"]), out)
    assert _text(spark, out) == ["(3,a)", "(2,b)", "(1,.)", "(1,c)"]


def test_bigram_program(spark):
    out = _out("bigrams")
    programs.bigram_top_k(spark, _write(["I will go. I will", "go I will"]), out, k=2)
    assert _text(spark, out) == ["i will\t3", "go i\t2"]


def test_triangle_program(spark):
    out = _out("tri")
    programs.triangles(spark, _write(["1\t2", "2\t3", "3\t1", "3\t4"]), out)
    assert _text(spark, out) == ["1"]


def test_window_programs(spark):
    path = _write(["the cat saw the dog", "", "The end of the day."])
    out = _out("ww")
    top = programs.word_window_top_k(spark, path, out, window=5, k=1)
    assert sorted(tuple(r) for r in top.collect()) == [(0, 1, "the", 2), (1, 1, "the", 2)]
    assert spark.read.parquet(out).count() == 2
    out = _out("bw")
    programs.bigram_window_top_k(spark, path, out, window=11, k=3)
    assert sorted(tuple(r)[1:] for r in spark.read.parquet(out).collect()) == [(1, "cat", "saw", 1), (2, "dog", "the", 1), (3, "end", "of", 1)]


def test_firewall_programs(spark):
    trace = _write(["10:00:02 1 10.0.0.1.5 > 10.0.0.9.80 tcp", "10:00:01 2 10.0.0.2.5 > 10.0.0.9.80 tcp",
                    "10:00:03 3 10.0.0.1.6 > 10.0.0.8.80 tcp"])
    blocks = _write(["1 Blocked ", "2 blocked ", "3 Allowed "])
    log_out, counts_out = _out("log"), _out("counts")
    programs.firewall_log(spark, trace, blocks, log_out, counts_out)
    assert _text(spark, log_out) == ["(10:00:01,2,10.0.0.2.5,10.0.0.9.80,blocked)",
                                     "(10:00:02,1,10.0.0.1.5,10.0.0.9.80,Blocked)"]
    log_out, counts_out = _out("log2"), _out("counts2")
    programs.firewall_log(spark, trace, blocks, log_out, counts_out, case_sensitive=True, strict=False,
                          tuple_text=False)
    assert _text(spark, counts_out) == ["10.0.0.1.5\t1"]


def test_sort_programs(spark):
    src = _write(["b\t2", "a\t1", "Z\tz", "9\tnine", "a\t0"])
    out = _out("total")
    programs.total_order_sort(spark, src, out, num_files=2)
    files = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    lines = [ln for f in files for ln in open(os.path.join(out, f)).read().splitlines()]
    assert lines == ["9\tnine", "Z\tz", "a\t0", "a\t1", "b\t2"]
    out = _out("first")
    programs.first_char_sort(spark, src, out, num_buckets=10)
    buckets = sorted(d for d in os.listdir(out) if d.startswith("bucket="))
    assert buckets == ["bucket=1", "bucket=5"]  # '9' -> 1; 'Z', 'a', 'b' -> classes 35..37 -> 5
    b5 = os.path.join(out, "bucket=5")
    files = sorted(f for f in os.listdir(b5) if f.startswith("part-"))
    lines = [ln for f in files for ln in open(os.path.join(b5, f)).read().splitlines()]
    assert lines == ["Z\tz", "a\t0", "a\t1", "b\t2"]


def test_table_programs(spark):
    gaz = _write(["IA\t1\t2\t3\t100\t5\t1.0\t1.0\t1.0\t1.0", "IA\t1\t2\t3\t50\t5\t1.0\t1.0\t1.0\t1.0",
                  "TX\t1\t2\t3\t120\t5\t1.0\t1.0\t1.0\t1.0"])
    out = _out("land")
    programs.land_area_top_k(spark, gaz, out)
    assert _text(spark, out) == ["IA\t150", "TX\t120"]
    repos = _write([",".join(["r1", "py"] + ["x"] * 10 + ["5"]), ",".join(["r0", "py"] + ["x"] * 10 + ["5"]),
                    ",".join(["r2", "go"] + ["x"] * 10 + ["1"])])
    out = _out("lang")
    programs.top_languages(spark, repos, out)
    assert _text(spark, out) == ["(py,2,r0,5)", "(go,1,r2,1)"]
    net = _write(["t 1 10.0.0.1.5 > 10.0.1.1.80 tcp", "t 2 10.0.0.2.5 > 10.0.1.2.80 TCP",
                  "t 3 10.0.0.1.6 > 10.0.2.1.80 tcp", "t 4 10.0.0.1.7 > 10.0.3.1.80 udp"])
    out = _out("dst")
    programs.distinct_destinations_top_k(spark, net, out)
    assert _text(spark, out) == ["10.0.0.1\t2", "10.0.0.2\t1"]


def test_repository_csv_naive_and_quoted(spark):
    from quarry.sources import text as src

    fields = ["x"] * 10
    line_quoted = ",".join(['"a,b"', "py"] + fields + ["7"])
    line_plain = ",".join(["c", "go"] + fields + ["3"])
    path = _write([line_quoted, line_plain])
    quoted = sorted(tuple(r) for r in src.read_repositories(spark, path, naive=False).collect())
    assert quoted == [("a,b", "py", 7), ("c", "go", 3)]
    naive = sorted(tuple(r) for r in src.read_repositories(spark, path, naive=True, strict=False).collect())
    assert naive == [('"a', 'b"', None), ("c", "go", 3)]  # the comma inside quotes shifts fields
