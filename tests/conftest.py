import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from podlake.session import get_spark, shared_dir
    s = get_spark("local[4]", app="podlake-tests", shuffle_partitions=8)
    shared_dir(s)  # the session's own spark.checkpoint.dir, or a private one in tests
    yield s
    s.stop()


@pytest.fixture(scope="session")
def t_small(spark):
    from podlake.sources.tables import tables
    from settings import SF_SMALL
    return tables(spark, SF_SMALL)
