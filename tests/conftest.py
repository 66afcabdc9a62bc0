import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from tests.session import session


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(request, spark):
    """Runs a test under two session time zones."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture
def settings(spark):
    """``settings(name=value)`` for the length of one test."""
    before = {}

    def change(values):
        for name, value in values.items():
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
