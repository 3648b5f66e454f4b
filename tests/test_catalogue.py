"""Every catalogue query against its SQL in DuckDB; those without SQL must run and give rows."""

import pytest

import oracle
from paths import DATA
from quire.plans import catalogue

D = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(D)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, D)
    if name in catalogue.SQL:
        assert not oracle.differences(df, catalogue.SQL[name], con)
    else:
        assert df.count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
