"""Tables that Spark sizes too low, and that grow with the input, are not broadcast."""

import public_tokenizers

from loomline.llm import near_copies, packing


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_band_keys_are_not_broadcast(spark, monkeypatch):
    plans, own = {}, near_copies.written
    monkeypatch.setattr(near_copies, "written", lambda df, name, *a: plans.setdefault(name, _plan(df)) and own(df, name, *a))
    nodes = own(spark.createDataFrame([(k, k % 3, [k // 2, 100 + k // 3]) for k in range(12)], "node long, fp long, keys array<long>"), "nodes")
    assert near_copies.groups(nodes).count()
    assert "SortMergeJoin" in plans["near-shards"] and "Broadcast" not in plans["near-shards"]


def test_counts_of_tasks_are_not_broadcast(spark):
    docs = spark.createDataFrame([(k, "some words " * (k % 5)) for k in range(40)], "doc_id long, text string")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert "Broadcast" not in _plan(packed)
    assert packed.count() == 40
