import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usagelens import build_session  # noqa: E402

AS_OF = datetime(2024, 1, 31, 1, 30)
SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
