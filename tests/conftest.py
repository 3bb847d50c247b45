import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """All rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
