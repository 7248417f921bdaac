"""Every registered query with a SQL check, value by value against DuckDB."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from thermolens.plans.checks import CHECKS
from thermolens.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, folder, duck, name):
    ours = QUERIES[name](spark, folder).toPandas()
    assert differences(ours, duck.execute(CHECKS[name]).df()) is None


def test_every_query_is_checked():
    assert set(QUERIES) == set(CHECKS)


def test_entry_has_one_row_per_zone(spark):
    rows = entry(spark).collect()
    assert len(rows) == 15 and sum(r.n for r in rows) == 1000
