"""Every query with a SQL form against DuckDB at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from lumenvox.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def values(df, columns):
    plain = lambda v: None if pd.isna(v) else v
    return sorted((tuple(plain(v) for v in row) for row in df[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, con, sf_dir, name):
    mine = catalogue.queries()[name](spark, sf_dir).toPandas()
    theirs = con.sql(catalogue.oracle_sql()[name]).df()
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    a, b = values(mine, columns), values(theirs, columns)
    assert len(a) == len(b)
    assert all(x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float)) and float(x) == float(y)) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


def test_driver_contract(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalogue.queries()) <= set(__spark_entry__.queries())
