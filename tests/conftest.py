import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sectorlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "sectorlens-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Evaluate column expressions on literal rows: rows(data, schema, expr) -> values."""
    def run(data, schema, *expressions):
        result = spark.createDataFrame(data, schema).select(*expressions).collect()
        return [r[0] if len(expressions) == 1 else tuple(r) for r in result]
    return run
