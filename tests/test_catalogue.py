"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tests.conftest import SMALL
from tests.oracle import check
from tidemark.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert check(spark, name, SMALL) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.queries()) >= set(entry.oracle_sql())
