import pytest

from conftest import SF, rows_of
from lociweave import queries

ORACLE = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, oracle, name):
    assert rows_of(queries.queries()[name](spark, SF).toPandas()) == oracle(ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(ORACLE)))
def test_other_queries_give_rows(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0


def test_entry_imports_and_has_the_flagship(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
