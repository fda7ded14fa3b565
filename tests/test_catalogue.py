"""Every catalogue query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    cell = lambda v: "NULL" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else f"{float(v):.6g}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, sf, con, name):
    assert plain(catalogue.QUERIES[name](spark, sf).toPandas()) == plain(con.sql(catalogue.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0
