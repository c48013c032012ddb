"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests import harness

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, CHECKS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return harness.duck(SF)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["producer_id", "name", "track_count", "artist_count", "avg_track_popularity"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result, _ = harness.compare(spark, con, name, QUERIES[name], CHECKS.get(name), SF)
    if result == "ok-EMPTY":  # nothing to compare in the smallest tables
        result, _ = harness.compare(spark, harness.duck(LARGER), name, QUERIES[name], CHECKS[name], LARGER)
    if name in CHECKS:
        assert result == "ok", result
    else:  # these have tests of their own; here they must give rows
        assert result.startswith("rows=") and result != "rows=0", result
