import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from claimtide.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("claimtide-tests", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached(spark):
    """What one module caches would stand in the plans that another looks at."""
    yield
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def small(spark):
    from claimtide.sources.staged import inputs

    return inputs(spark, SMALL)
