"""Every query against the same query in SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from homegrid.plans import catalog, oracle
from tests.conftest import SMALL

@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"create view events as select * from '{SMALL}/events.parquet'")
    return con


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        first = df[name].dropna().head(1)
        if str(df[name].dtype).startswith("datetime") or (
            len(first) and type(first.iloc[0]).__name__ == "date"
        ):
            df[name] = pd.to_datetime(df[name]).astype("datetime64[us]")
        elif df[name].dtype.kind in "iu":
            df[name] = df[name].astype("int64")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(oracle.QUERIES))
def test_matches_sql(spark, db, name):
    got = comparable(entry.queries()[name](spark, SMALL).toPandas())
    want = comparable(db.execute(entry.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=0)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(oracle.QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    days = entry.entry(spark)
    assert days.count() == 30
    assert {"date", "first_1kw", "last_2kw", "peak_solar", "daily_total"} <= set(days.columns)
