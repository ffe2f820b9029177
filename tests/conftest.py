import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from convoy.session import build_session
    s = build_session("local[4]", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="convoy-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="convoy-test-")


def make_fleet(spark, **tables):
    """Fleet with the given tables as row lists (missing tables empty)."""
    from convoy.sources.fleet import FLEET_TABLES, Fleet
    from convoy.sources.schemas import FLEET_SCHEMAS
    return Fleet(**{t: spark.createDataFrame(tables.get(t, []), FLEET_SCHEMAS[t])
                    for t in FLEET_TABLES})
