"""Every registered query against its SQL, on the smallest tables."""

import pytest

from playlake.queries import ORACLE, QUERIES
from tests.check_oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLE[name]) is None


def test_entry_returns_five_artists(spark):
    import __spark_entry__ as driver

    top = driver.entry(spark)
    assert top.columns == ["artist_id", "name", "plays"]
    assert top.count() == 5
