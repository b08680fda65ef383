import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark import build_session

    session = build_session("tidemark-tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    from tidemark.plans.store import Store

    return Store(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
