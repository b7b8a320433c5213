import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siltstone.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values():
    """The rows of a frame as sorted tuples."""
    def collect(df, *columns):
        rows = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in rows), key=str)

    return collect
