"""Rejected lines with their reasons; distinct counts from bitmaps that merge."""

import datetime
import random
from collections import Counter

import pytest

from quarry.operators import distinct_bitmaps
from quarry.sinks import manifest
from quarry.sources import rejects
from quarry.sources.text import parse_edges

LINES = ["1\t2", "1\t2\t", "+7\t-3", "", "x", "1\t2\t3", " 1\t2", "1 \t2", "a1\t2", "9223372036854775808\t1", "-9223372036854775808\t1", "\t1", "1\t\t2", "1\t٣", "1\t2\n"]


def test_edges_and_their_rejects_make_up_all_lines(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in [*LINES, None]], "value string")
    judged = rejects.edges_with_reason(lines)
    found = rejects.write_checked(judged, str(tmp_path), most_rejects=0.9)
    good, bad = rejects.records(spark, str(tmp_path)), rejects.rejects(spark, str(tmp_path))
    assert found == {"lines": len(LINES) + 1, "rejects": bad.count()}
    assert Counter(map(tuple, good.collect())) == Counter(map(tuple, parse_edges(lines).collect()))
    assert {(r.line, r.reason) for r in bad.collect()} == {
        ("", rejects.FIELDS), ("x", rejects.FIELDS), ("1\t2\t3", rejects.FIELDS), (" 1\t2", rejects.NUMBER), ("1 \t2", rejects.NUMBER), ("a1\t2", rejects.NUMBER), ("9223372036854775808\t1", rejects.RANGE),
        ("\t1", rejects.NUMBER), ("1\t\t2", rejects.FIELDS), ("1\t٣", rejects.NUMBER), ("1\t2\n", rejects.NUMBER), (None, rejects.FIELDS),
    }


def test_too_many_rejects_publish_nothing(spark, tmp_path):
    good, bad = (spark.createDataFrame([(x,) for x in own], "value string") for own in (["1\t2"] * 9 + ["x"], ["x"] * 9 + ["1\t2"]))
    rejects.write_checked(rejects.edges_with_reason(good), str(tmp_path), 0.1)
    with pytest.raises(rejects.TooManyRejects, match="9 of 10"):
        rejects.write_checked(rejects.edges_with_reason(bad), str(tmp_path), 0.1)
    assert manifest.versions(spark, str(tmp_path)) == [1] and rejects.records(spark, str(tmp_path)).count() == 9


def test_fields_name_the_first_that_is_bad(spark):
    lines = spark.createDataFrame([(x,) for x in ["a 1 b", "a x b", "a 99999999999 b", "a 1", "a", "a 2 b c", "", "a  b"]], "value string")
    got = rejects.fields_with_reason(lines, " ", {"who": (0, "string"), "n": (1, "int"), "what": (2, "string")})
    assert {r.line: (r.who, r.n, r.what, r.reason) for r in got.collect()} == {
        "a 1 b": ("a", 1, "b", None), "a x b": (None, None, None, "n: no whole number"), "a 99999999999 b": (None, None, None, "n: beyond the range"), "a 1": (None, None, None, "what: missing"),
        "a": (None, None, None, "n: missing"), "a 2 b c": ("a", 2, "b", None), "": (None, None, None, "n: missing"), "a  b": (None, None, None, "n: no whole number"),
    }


def test_distinct_counts_of_days_add_up(spark, tmp_path):
    r, folder, rows = random.Random(6), str(tmp_path / "d"), []
    days = [datetime.date(2024, 1, d) for d in range(1, 8)]
    for batch in range(3):
        own = [(r.choice(days), r.choice(["a", "b", None]), r.choice([None, *map(str, range(50 * (batch + 1)))])) for _ in range(400)] + [(days[0], "empty", None)]
        df = spark.createDataFrame(own, "day date, key string, value string")
        assert distinct_bitmaps.add(df, folder, batch) and not distinct_bitmaps.add(df, folder, batch)
        rows += own
        for lo, hi in ((None, None), (days[2], days[4])):
            want = {}
            for d, k, v in rows:
                if lo is None or lo <= d <= hi:
                    want.setdefault(k, set()).add(v)
            got = distinct_bitmaps.distinct_counts(spark, folder, lo, hi)
            assert {x.key: x.n_distinct for x in got.collect()} == {k: len(v - {None}) for k, v in want.items()}
    numbers = [x.number for x in manifest.read(spark, folder, "numbers").collect()]
    assert sorted(numbers) == list(range(len(numbers)))
