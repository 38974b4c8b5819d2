"""Every registered query against its check SQL on the smallest test set."""

import pytest
from checker import compare, duck
from conftest import DATA

from slowtide.plans import all_checks, all_queries

FOLDER = f"{DATA}/sf0.001"
CHECKS = all_checks()
# the smallest set has no row for these
MAY_BE_EMPTY = {"d33_sample_by_severity", "u02_overlapping_branches"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    df = all_queries()[name](spark, FOLDER)
    if name not in CHECKS:
        assert df.count() > 0
        return
    problem = compare(df, con, CHECKS[name])
    assert problem is None or (problem == "both empty" and name in MAY_BE_EMPTY), problem


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
