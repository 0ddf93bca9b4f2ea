"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from spanloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "year"):
        return str(value)[:10]
    return round(float(value), 6) if isinstance(value, float) else value


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr([plain(v) for v in r]) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    found = catalogue.QUERIES[name](spark, SF).toPandas()
    if name in catalogue.SQL:
        assert rows(found) == rows(duck.sql(catalogue.SQL[name]).df())
