import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("orderloom-tests", cores=8)
    yield session
    session.stop()


@pytest.fixture
def zone(spark):
    """Run the rest of a test under another session time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")

    def switch(name):
        spark.conf.set("spark.sql.session.timeZone", name)

    yield switch
    spark.conf.set("spark.sql.session.timeZone", before)


def rows(df):
    """All rows as sorted tuples; NULL sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
