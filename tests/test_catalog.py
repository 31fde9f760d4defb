"""Every registered query against its SQL, and the shape of the driver contract."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from strikepath.catalog.oracle import ORACLE_SQL
from strikepath.catalog.queries import QUERIES

TABLES = ("events", "orders", "lineitem")
# Group letter and highest number of the operator list. S10 lists file names and reads no table; it is tested alone.
OPERATORS = {"s": 9, "p": 13, "j": 8, "a": 34, "w": 10, "o": 8, "u": 3, "t": 13, "f": 25, "v": 25, "d": 8}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(df):
    df = df[sorted(df.columns)]
    cells = lambda row: tuple("\0" if pd.isna(v) else f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)
    return sorted(cells(row) for row in df.itertuples(index=False))


def test_every_operator_has_a_query_and_sql():
    names = QUERIES
    found = {m.group(1, 2) for m in (re.match(r"([a-z])(\d\d)_", n) for n in names) if m}
    missing = [f"{g}{i:02d}" for g, last in OPERATORS.items() for i in range(1, last + 1) if (g, f"{i:02d}") not in found]
    assert not missing
    assert set(names) == set(ORACLE_SQL)
    assert set(names) <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    theirs = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normal(mine) == normal(theirs)
    assert len(mine) > 0 or name == "d05_duplicate_keys"


def test_entry_is_lazy_and_typed(spark):
    df = entry.entry(spark)
    assert df.columns == ["week_start", "threshold_band", "n_markets"]
    assert df.count() > 0
