"""The endless firewall join: equal to the batch over restarts, state bounded, what is too far apart does not meet."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import relational
from quarry.sources.text import parse_trace, parse_verdicts
from quarry.streaming import firewall

HOUR = 3600


def _write(folder, name, lines, when):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write("".join(f"{x}\n" for x in lines))
    os.utime(f"{folder}/{name}.txt", (when, when))


def _lines(spark, folder):
    return spark.read.text(folder)


def test_log_and_counts_equal_the_batch_over_restarts(spark, tmp_path):
    r = random.Random(2)
    trace, verdicts, folder = (str(tmp_path / x) for x in ("trace", "verdicts", "out"))
    for run in range(3):
        for k in range(3):
            when = 1_000_000 + (run * 3 + k) * 600
            _write(trace, f"{run}{k}", [f"10:00:{k:02} {r.randrange(40)} 10.0.0.{r.randrange(5)} > 10.1.0.{i}" for i in range(25)], when)
            _write(verdicts, f"{run}{k}", [f"{r.randrange(40)} {r.choice(['Blocked', 'blocked', 'Allowed'])}" for _ in range(15)], when + r.randrange(600))
        log, counts = firewall.advance(spark, trace, verdicts, folder, max_files=1, window="1 second")
        want = relational.firewall_log(parse_trace(_lines(spark, trace)), parse_verdicts(_lines(spark, verdicts)), sort=False)
        assert Counter(map(tuple, log.collect())) == Counter(map(tuple, want.collect()))
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, relational.blocked_count_by_source(want).collect()))
    assert log.count() > 100


def test_state_is_bounded_and_far_verdicts_do_not_meet(spark, tmp_path):
    trace, verdicts = str(tmp_path / "trace"), str(tmp_path / "verdicts")
    for k in range(12):
        when = 1_000_000 + k * 6 * HOUR
        _write(trace, f"{k:02}", [f"t {100 * k + i} s > d" for i in range(50)], when)
        old = [f"{100 * (k - 8) + i} Blocked" for i in range(50)] if k >= 8 else []  # two days late
        _write(verdicts, f"{k:02}", [f"{100 * k + i} Blocked" for i in range(0, 50, 5)] + old, when + HOUR // 2)
    stream = firewall.firewall_log_stream(*firewall.text_streams(spark, trace, verdicts, 1), within="12 hours")
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "log"))
         .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "log"))
    assert sorted(x.connection_id for x in got.collect()) == sorted(100 * k + i for k in range(12) for i in range(0, 50, 5))
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    assert max(rows[6:]) <= 6 * 120 and rows[-1] < 12 * 60  # a few files' rows, not all that came


def test_null_ids_never_match(spark, tmp_path):
    at = F.lit("2020-01-01").cast("timestamp").alias("arrived")
    trace = spark.createDataFrame([("t", None, "s", "d"), ("t", 1, "s", "d")], "time string, connection_id int, source_ip string, destination_ip string").select("*", at)
    verdicts = spark.createDataFrame([(None, "Blocked"), (1, "Blocked"), (1, "blocked")], "connection_id int, action string").select("*", at)
    assert firewall.firewall_log_stream(trace, verdicts).count() == 2
    assert firewall.firewall_log_stream(trace, verdicts, case_sensitive=True).count() == 1
