import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerproof.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of a few hundred bytes and these into batches of a few
    lines, so that records straddle both."""
    small = {
        "spark.sql.files.maxPartitionBytes": "300",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "3",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)
