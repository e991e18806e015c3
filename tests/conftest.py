import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from basketry.session import build_session, checkpoint_root
    s = build_session("local[4]", app="basketry-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # tests: a private folder only if the session names none
    yield s
    s.stop()


@pytest.fixture
def tmp(spark):
    from basketry.session import shared_dir
    return shared_dir(spark, "test")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, *cols):
    """Sorted list of tuples (selected columns) for order-free comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
