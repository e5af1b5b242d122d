"""Every query of the catalog against its DuckDB oracle on sf0.001 (the driver does the same at
sf0.01): same columns, same rows, same values, order-insensitive."""

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as se
from tidemark.plans.catalog import CATALOG
from tidemark.sources.tables import TABLES
from tools.check_oracle import _rows

NAMES = sorted(CATALOG)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert all(sql for _, sql in CATALOG.values())
    assert set(CATALOG) <= set(se.queries()) and set(CATALOG) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = CATALOG[name][0](spark, SF_SMALL).toPandas()
    exp = con.execute(CATALOG[name][1]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["event_type", "window_start", "window_end", "cnt", "rn"]
    assert df.count() > 0
