"""Every query that has SQL gives the rows that DuckDB gives, over the smallest test tables."""

import decimal
import os

import pytest

from loomline import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def same_rows(df, found):
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    at = [found.columns.index(c) for c in names]
    got = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    same_rows(queries.queries()[name](spark, SF), duck.sql(queries.oracle_sql()[name]))


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert sum(r["documents"] for r in rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert set(entry.oracle_sql()) <= set(entry.queries())
