"""Tables of several files, with rows without text, as large inputs have them."""

import hashlib
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline import io_queries
from loomline.functions import text as X
from loomline.functions import vectors
from loomline.operators import dedup, rules
from loomline.queries import oracle_sql, queries
from loomline.sources import readers


def same_as_sql(spark, sf_dir, name):
    found = queries()[name](spark, str(sf_dir))
    con = duckdb.connect()
    for path in sf_dir.iterdir():
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    told = con.sql(oracle_sql()[name])
    assert sorted(map(repr, (tuple(r) for r in found.select(*told.columns).collect()))) == sorted(map(repr, told.fetchall()))


@pytest.fixture()
def sf_dir(tmp_path):
    """Documents in three files, rows without text among them, and a benchmark."""
    con = duckdb.connect()
    for name, files in (("documents", 3), ("benchmark", 1)):
        (tmp_path / f"{name}.parquet").mkdir()
        for k in range(files):
            key = "item_id" if name == "benchmark" else "doc_id"
            text = "CASE i % 7 WHEN 2 THEN '' WHEN 5 THEN NULL ELSE 'text number ' || i END"
            con.sql(f"COPY (SELECT 1000 - i AS {key}, {text} AS text, 'en' AS lang, CASE WHEN i % 3 > 0 THEN 'web' END AS source FROM range({40 * k}, {40 * k + 40}) t(i)) TO '{tmp_path}/{name}.parquet/part-{k:04}.parquet'")
    return tmp_path


def test_parquet_rows_with_text_are_counted_over_files(spark, sf_dir):
    same_as_sql(spark, sf_dir, "read_parquet_documents")


def test_export_leaves_out_documents_without_text(spark, sf_dir):
    same_as_sql(spark, sf_dir, "export_jsonl")


def test_sources_of_several_files_keep_apart(spark, sf_dir):
    same_as_sql(spark, sf_dir, "collect_sources")


def test_hash_embedding_of_repeated_and_null_ids(spark, tmp_path):
    """Rows of one id are one text's, those without an id too (left out before); characters of two to four bytes."""
    con = duckdb.connect()
    (tmp_path / "documents.parquet").mkdir()
    rows = "SELECT 1 AS doc_id, repeat('long text ', 40) AS text UNION ALL SELECT 1, 'more of it' UNION ALL SELECT 2, 'ab' UNION ALL SELECT 3, '' UNION ALL SELECT NULL, 'null id' UNION ALL SELECT 4, 'é€😀 e\u0301x' UNION ALL SELECT NULL, 'once more'"
    con.sql(f"COPY ({rows}) TO '{tmp_path}/documents.parquet/a.parquet'")
    same_as_sql(spark, tmp_path, "hash_embedding")


def test_embedding_of_a_very_long_text(spark):
    """Time grew with the square of a text's length before."""
    df = spark.createDataFrame([(1, "long text " * 100_000)], "doc_id long, text string")
    began = time.perf_counter()
    assert sum(r["weight"] ** 2 for r in vectors.embed_sparse(df).collect()) == pytest.approx(1)
    assert time.perf_counter() - began < 30


def test_grams_that_share_a_place_keep_their_buckets(monkeypatch):
    monkeypatch.setattr(vectors, "TABLE_BITS", 2)
    texts = ["the quick brown fox", "", "ab", "jumps over the dog"]
    owner, bucket = vectors.Buckets(256, 3).of(texts)
    plain = sorted((i, int(hashlib.md5(g.encode()).hexdigest(), 16) % 256) for i, t in enumerate(texts) for g in ([t[k : k + 3] for k in range(len(t) - 2)] or ([t] if t else [])))
    assert sorted(zip(owner.tolist(), bucket.tolist(), strict=True)) == plain


def test_ordered_lines_in_several_files(spark):
    """One task wrote all ordered lines before, and lines of several files had the same places."""
    rows = spark.range(9000).select(F.concat(F.lit("line "), "id").alias("value"), F.col("id").alias("k")).repartition(8)
    size, spark_size = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(size, "false")
    try:
        path = io_queries._lines(rows, "many.txt", "k", single=False)
    finally:
        spark.conf.set(size, spark_size)
    found = readers.numbered_lines(spark, path).collect()
    assert len({r["file"] for r in found}) > 1 and len(found) == 9000 and all(r["value"] == f"line {r['place']}" for r in found)


def test_python_functions_take_texts_in_pieces():
    batch = pa.array(["e\u0301" * 50, None] * 1500)
    made = list(X._compose(iter([batch])))
    assert len(made) > 1 and pa.concat_arrays(made).to_pylist() == ["\u00e9" * 50, None] * 1500
    assert max(len(p) for p in X.in_pieces(batch)) <= X.PIECE_ROWS


def test_only_texts_that_composition_may_change_reach_python(spark):
    texts = ["\u00e9t\u00e9 \u2019", "\u0939\u093f\u0928\u094d\u0926\u0940", "e\u0301", "\u0958", "q\u0307\u0323", "\u1100\u1161"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    assert [r[0] for r in df.orderBy("i").select(F.col("t").rlike(X.uncomposed())).collect()] == [False, False, True, True, True, True]


def test_first_places_of_signatures(spark):
    df = spark.createDataFrame([(1, "some text of words"), (2, ""), (3, "ab")], "i long, t string")
    for whole, first in df.select(vectors.signatures()(F.col("t")), vectors.signatures(places=16)(F.col("t"))).collect():
        assert len(whole) == 128 and whole[:16] == first
    h = np.arange(1, 5000, dtype=np.uint64)
    assert (vectors.minhash(h, 128)[:16] == vectors.minhash(h, 128, places=16)).all()


def test_words_are_counted_once_for_all_rules(spark):
    assert str(spark.range(1).select(rules.drop_reason(F.lit("some text"), None).alias("r"))._jdf.queryExecution().analyzed()).count("[0-9A-Za-z]++, x") == 1


def test_blocks_of_vectors_stay_few(spark):
    rows = spark.range(40_000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")).alias("embedding"))
    plan = dedup.similar_pairs(rows, 0.4)._jdf.queryExecution().analyzed().toString()
    assert "sequence(0, 15" in plan and "as array<double>" not in plan


def test_dense_embedding_rounds_as_the_sql(spark, tmp_path):
    """0.94184998 was 0.94185000 in single precision, so 0.9419; with white space of all kinds."""
    con = duckdb.connect()
    (tmp_path / "documents.parquet").mkdir()
    odd = "SELECT 2 AS doc_id, chr(8195) || ' odd' || chr(160) || chr(9) || 'white  space' || chr(28) || chr(10) AS text UNION ALL SELECT 3, 'x' UNION ALL SELECT 4, '' UNION ALL SELECT 5, NULL UNION ALL SELECT 6, ' 漢é '"
    con.sql(f"COPY (SELECT 1 AS doc_id, repeat('a', 53) || repeat('b', 145) AS text UNION ALL {odd}) TO '{tmp_path}/documents.parquet/a.parquet'")
    same_as_sql(spark, tmp_path, "dense_embedding")


def test_buckets_of_texts_longer_than_a_step():
    texts = ["", "ab", " ".join(map(str, range(40_000))), "c", "\u6f22\u00e9\U0001f600" * 50_000, "abc"]
    for ngram in (1, 2, 3, 4):
        owner, bucket = vectors.Buckets(256, ngram).of(texts)
        for i, t in enumerate(texts):
            grams = [t[k : k + ngram] for k in range(max(len(t) - ngram + 1, 1 if t else 0))]
            assert bucket[owner == i].tolist() == [hashlib.md5(g.encode()).digest()[-1] for g in grams]


@pytest.mark.parametrize("name", ["dense_embedding", "hash_embedding", "minhash_places"])
def test_what_is_exploded_is_made_once(spark, sf_dir, name):
    """Spark ran the Python function a second time below the generator, to leave out rows without elements."""
    plan = queries()[name](spark, str(sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
