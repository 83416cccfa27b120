import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    s = session()
    yield s
    s.stop()


@pytest.fixture()
def small_buckets(spark):
    """Make every ordered operator cut its input into buckets."""
    from callgrid.operators.ordered import BUCKET_BYTES_KEY

    spark.conf.set(BUCKET_BYTES_KEY, "1000")
    yield
    spark.conf.unset(BUCKET_BYTES_KEY)


def rows(df, *cols):
    got = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in got.collect()), key=repr)
