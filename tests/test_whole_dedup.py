"""Deduplication does the same at every size."""

import inspect

import numpy as np

from loomline.operators import dedup


def test_semantic_has_one_path_and_collapses_copies(spark, monkeypatch):
    assert inspect.signature(dedup.semantic).parameters["exact_up_to"].default is None
    rng = np.random.default_rng(4)
    v = rng.normal(size=(40, 8))
    v[[5, 9, 30, 31, 39]] = v[2]
    v[[20, 33]] = v[12]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[[7, 8]] = 0
    s = np.round(np.round(v @ v.T, 6), 4)
    kept, want = [], {}
    for i in range(len(v)):
        near = [k for k in kept if np.round(v[i] @ v[k], 6) >= 0.4]
        want[i] = max(near, key=lambda k: (s[i, k], -k), default=None)
        if want[i] is None:
            kept.append(i)
    counted = []
    pairs = dedup.similar_pairs
    monkeypatch.setattr(dedup, "similar_pairs", lambda df, *a: counted.append(df.count()) or pairs(df, *a))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["parent"], r["similarity"]) for r in dedup.semantic(df, 0.4).collect()}
    assert {i: p for i, (p, _) in got.items()} == want and counted == [33]
    assert all(abs(x - s[i, p]) < 1e-9 for i, (p, x) in got.items() if p is not None)


def test_near_reports_the_earliest_similar_kept_parent_in_rounds(spark, monkeypatch):
    """7 shares buckets with 3 and 5 and is like both; 3 isn't free in the first round, because 1 leads another of its buckets."""
    from loomline.functions import text as X

    values = {1: [100, 101], 3: [1, 2, 3, 4], 5: [3, 4, 5, 6], 7: [1, 2, 3, 4, 5, 6]}
    held = [("x", 1), ("x", 3), ("y", 3), ("y", 7), ("z", 5), ("z", 7)]
    buckets = spark.createDataFrame(held, "bucket string, node long")
    payload = spark.createDataFrame(list(values.items()), "node long, value array<long>")
    got = {}
    for one_task in (0, 60_000):
        monkeypatch.setattr(dedup, "ONE_TASK", one_task)
        got[one_task] = {r["node"]: r["parent"] for r in dedup.resolve(buckets, payload, X.jaccard, dedup.set_jaccard, 0.6).collect()}
    assert got[0] == got[60_000] == {1: None, 3: None, 5: None, 7: 3}
