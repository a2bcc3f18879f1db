import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quern.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": 4, "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder(tmp_path):
    """A new folder below the test's own one."""
    made = []

    def new(label="t"):
        made.append(label)
        return str(tmp_path / f"{label}-{len(made)}")

    return new


def rows_of(df, *order):
    """Rows as sorted tuples."""
    df = df.select(*order) if order else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
