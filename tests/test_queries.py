import pytest

from skeinwork import catalogue

from .duck import connect, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    same(catalogue.queries()[name](spark, sf_dir), con, catalogue.oracle_sql()[name])


def test_entry_imports_and_runs(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["id", "chosen_trace", "search_text", "tags"]
