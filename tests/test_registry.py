"""Every registry query against its DuckDB twin at sf0.01 (the driver's gate),
and the smoke entry at sf0.001."""

import os

import pytest

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["event_id", "user_id", "event_type", "value"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from panelforge.session import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _names():
    from panelforge.plans import catalog, oracle
    return sorted(set(oracle.SQL) & set(catalog.QUERIES))


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from scripts.check_oracle import digest
    sp = E.queries()[name](spark, SF).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert digest(sp) == digest(dk)


def test_rows_only_queries_run(spark):
    import __spark_entry__ as E
    from panelforge.plans import catalog
    for name in sorted(set(catalog.QUERIES) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SF).count() > 0, name
