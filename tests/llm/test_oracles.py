"""Registered queries against their DuckDB SQL on the smallest driver tables."""

import os
import subprocess
import sys

import duckdb
import pytest

from quarry.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not available")
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(x) for x in got.select(columns).collect()) == sorted(found.fetchall())


def test_executors_need_not_have_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from quarry.session import build_session
from quarry.llm import langid, linededup, pii, substring, suffix
spark = build_session("local[2]", 2)
docs = spark.createDataFrame([(i, "the same words again and again " * 9 + str(i), "en") for i in range(9)], "doc_id long, text string, lang string")
for f in (langid.identify, linededup.deduplicate, pii.find, substring.deduplicate, suffix.deduplicate):
    assert f(docs).count() == 9
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env, timeout=300)
