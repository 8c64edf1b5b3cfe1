import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledger_spark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def day():
    return datetime.date.fromisoformat


def rows(df, *columns):
    """Rows as sorted tuples, None first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: [(v is not None, v) for v in r],
    )
