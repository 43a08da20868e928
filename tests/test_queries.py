"""Each core query against its SQL on the smallest tables."""

import pytest

from clipwright.plans import registry
from tests.helpers import DATA, rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert rows_of(registry.queries()[name](spark, DATA)) == sql_rows(registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
