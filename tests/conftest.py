import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from placekit.session import get_spark
    s = get_spark("local[4]", app_name="placekit-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def one(df, col=None):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][col] if col else rows[0]
