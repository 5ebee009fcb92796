"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from support import SF_SMALL

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(SF_SMALL):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in ["customer", "part", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _names():
    """The model's queries; those of the training data have their own tests."""
    from lapsekit.plans.registry import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import rows_of
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    scols, s = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    ocols, o = rows_of(rel.columns, rel.fetchall())
    assert scols == ocols
    assert s == o


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 6
    assert df.columns[:3] == ["definition_name", "from_quarter", "to_quarter"]


def test_every_query_has_an_oracle():
    from lapsekit.checks.oracle_sql import ORACLES
    assert set(_names()) == set(ORACLES)
