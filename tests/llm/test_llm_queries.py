"""The training-data queries that have SQL, and all of them over the smallest tables."""

import os

import pytest

from loomline.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df, found = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    at = [found.columns.index(c) for c in names]
    assert sorted(map(repr, ([r[c] for c in names] for r in df.collect()))) == sorted(map(repr, ([r[i] for i in at] for r in found.fetchall())))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"op9_packing"}))
def test_a_row_for_each_input_row(spark, name):
    source = "pages" if name.startswith("op5_") else "documents"
    assert queries.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
