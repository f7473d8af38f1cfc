"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

from numbers import Real

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = {k: v for k, v in entry.queries().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return "null"
    return repr(float(value)) if isinstance(value, Real) and not isinstance(value, bool) else str(value)


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, sf_dir, name):
    found = OWN[name](spark, sf_dir).toPandas()
    if name in entry.oracle_sql():
        assert rows(found) == rows(duck.execute(entry.oracle_sql()[name]).df())
    else:
        assert len(found)


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc", "run", "times", "welded"]
