"""Every query with SQL against DuckDB at the smallest scale; entry() and the corpus guard."""

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _value(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.oracle_sql() if not n.startswith(("op", "pipeline")) or n in ("optimal_discount", "optimal_uplift", "offer_majority")))
def test_query_equals_its_sql(spark, sql, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = sql.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted(repr(tuple(_value(r[c]) for c in columns)) for r in got.collect())
    assert rows == sorted(repr(tuple(_value(r[i]) for i in at)) for r in want.fetchall())


def test_entry_has_rows(spark):
    if os.path.isdir(SF):
        assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
