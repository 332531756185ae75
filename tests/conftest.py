import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app_name="quarry-tests")
    yield s
    s.stop()


def lines_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")
