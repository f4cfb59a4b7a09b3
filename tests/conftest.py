import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def table(spark):
    """Small table from rows and a schema."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def values():
    """Rows of a frame as sorted tuples, in a given column order."""

    def read(df, *columns):
        rows = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return read
