"""Operators against sequential renderings on small inputs, and the awkward rows of each."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.functions.vectors import hashing_embedding
from loomline.operators import annotation, dedup, matching, rules, search, speech, stats, synthetic


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_exact_keeps_the_first(spark):
    df = frame(spark, [(3, "x"), (1, "x"), (2, "y"), (4, "x"), (5, None), (6, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["parent"] for r in dedup.exact(df).collect()}
    assert got == {1: None, 2: None, 3: 1, 4: 1, 5: None, 6: None}


def jaccard(a, b, k=4):
    s = [{t[i : i + k] for i in range(max(1, len(t) - k + 1))} for t in (" ".join(a.split()), " ".join(b.split()))]
    return len(s[0] & s[1]) / len(s[0] | s[1]) if all((a, b)) else 0.0


def sequential(texts, threshold):
    kept, parents = [], {}
    for i, t in texts:
        hit = next((k for k, u in kept if jaccard(t, u) >= threshold), None)
        parents[i] = hit
        if hit is None:
            kept.append((i, t))
    return parents


def near_texts():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    texts = []
    for i in range(25):
        base = list(rng.choice(words, 60))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            base[int(rng.integers(0, 60))] = str(rng.choice(words))
            texts.append(" ".join(base))
    return list(enumerate([*texts, texts[0], "", "tiny", "tiny", "ab"]))


@pytest.mark.parametrize("one_task", [60_000, 0])
def test_near_is_sequential_keep_first(spark, monkeypatch, one_task):
    """Both in one task and in rounds; a chain a~b, b~c, a!~c keeps a and c."""
    monkeypatch.setattr(dedup, "ONE_TASK", one_task)
    texts = near_texts()
    got = {r["doc_id"]: (r["parent"], r["similarity"]) for r in dedup.near(frame(spark, texts, "doc_id long, text string"), threshold=0.75).collect()}
    want = sequential(texts, 0.75)
    assert {i: p for i, (p, _) in got.items()} == want
    by = dict(texts)
    assert all(s == round(jaccard(by[i], by[p]), 4) for i, (p, s) in got.items() if p is not None) and any(p is not None for p in want.values())


def test_near_of_nothing(spark):
    assert dedup.near(frame(spark, [], "doc_id long, text string")).count() == 0


def test_semantic_chain_keeps_its_ends(spark):
    angle = lambda d: [math.cos(math.radians(d)), math.sin(math.radians(d))]
    rows = [(i, angle(d)) for i, d in enumerate((0, 20, 40, 80, 81, 200))]
    got = {r["vec_id"]: r["parent"] for r in dedup.semantic(frame(spark, rows, "vec_id long, embedding array<float>"), 0.92).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: None, 4: 3, 5: None}


def test_semantic_by_projections_finds_the_same(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 32))
    v = np.concatenate([base, base[:30] + rng.normal(size=(30, 32)) * 0.15])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = frame(spark, [(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    kept = lambda d: {r["vec_id"] for r in d.collect() if r["parent"] is None}
    assert kept(dedup.semantic(df, 0.92)) == kept(dedup.semantic(df, 0.92, exact_up_to=0)) and len(kept(dedup.semantic(df, 0.92))) < 90


def test_similar_pairs_over_many_blocks(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(80, 4))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = frame(spark, [(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    want = {(i, j) for i, j in itertools.combinations(range(80), 2) if round(float(v[i] @ v[j]), 6) >= 0.8}
    for blocks in (1, 5):
        got = [(r["a"], r["b"]) for r in dedup.similar_pairs(df, 0.8, blocks=blocks).collect()]
        assert set(got) == want and len(got) == len(want)


def test_bulk_job_keeps_first(spark):
    good = "this is a perfectly good sentence"
    df = frame(spark, [(2, good), (1, good + " "), (3, "&&& %%%"), (4, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in dedup.filter_and_dedup(df, order="doc_id").collect()] == [1]
    assert dedup.filter_and_dedup(df).count() == 1


def test_contamination(spark):
    docs = frame(spark, [(1, "zero one two three four five six"), (2, "Three FOUR five six seven"), (3, "one two"), (4, ""), (5, None)], "doc_id long, text string")
    bench = frame(spark, [(7, "three four five six"), (6, "two three four five nine"), (8, "one two"), (9, "")], "item_id long, text string")
    got = {r["doc_id"]: (r["bench_id"], r["ngram"]) for r in matching.contamination(docs, bench, 3).collect()}
    assert got == {1: (6, "two three four"), 2: (6, "three four five"), 3: (8, "one two")}
    other = matching.contamination(docs, bench.withColumn("rank", -F.col("item_id")), 3, bench_order="rank")
    assert {r["doc_id"]: r["bench_id"] for r in other.collect()}[2] == 7
    assert sorted(r["doc_id"] for r in matching.without(docs, matching.contamination(docs, bench, 3)).collect()) == [4, 5]


def test_align(spark):
    rows = [(0, "a", "p", "en", "In 2020 Delhi had 5 parks"), (1, "b", "p", "hi", "2020 5 Delhi parks had more"), (2, "c", "p", "en", "x"), (3, "d", None, "en", "y"), (4, "e", "q", None, ""), (5, "f", "q", "en", "z")]
    got = {r["id"]: r for r in matching.align(frame(spark, rows, "doc_id long, id string, parallel_id string, language string, text string")).collect()}
    assert set(got) == {"align-p-a-b", "align-p-b-c", "align-q-e-f"}
    assert got["align-q-e-f"]["source_language"] == "und" and got["align-q-e-f"]["alignment_score"] == 0.0
    length = 1 - (27 / 25 - 1) / 2.5
    assert got["align-p-a-b"]["alignment_score"] == pytest.approx(round(0.6 * length + 0.4 * 1.0, 4))


def kappa(a, b):
    n = len(a)
    po = sum(x == y for x, y in zip(a, b)) / n
    pe = sum(a.count(k) / n * b.count(k) / n for k in {*a, *b})
    return 1.0 if pe == 1 else round((po - pe) / (1 - pe), 4)


def test_cohen(spark):
    for a, b in ((list("xyxy"), list("xyxy")), (list("xxyy"), list("yyxx")), (list("xxxx"), list("xxxx")), (list("xyzxy"), list("xyyxx"))):
        df = frame(spark, list(zip(a, b)), "a string, b string")
        assert annotation.cohen_kappa(df).first()["kappa"] == kappa(a, b)
        assert annotation.percent_agreement(df).first()["agreement"] == pytest.approx(sum(x == y for x, y in zip(a, b)) / len(a))
    none = frame(spark, [], "a string, b string")
    assert annotation.cohen_kappa(none).first()["kappa"] == 0.0 and annotation.percent_agreement(none).first()["agreement"] == 0.0


ITEMS = [("i1", "k", [("a", "k"), ("b", "k"), ("c", "d")]), ("i2", "d", [("a", "d"), ("b", "k"), ("c", "x")]), ("i3", None, [("a", "k"), ("b", "k"), ("c", "k")]), ("i4", "k", [])]


def items(spark):
    rows = [(i, "t", "classification", g, [(i, a, label, 1.0) for a, label in xs]) for i, g, xs in ITEMS]
    return frame(spark, rows, "id string, text string, task string, gold_label string, annotations array<struct<item_id:string,annotator_id:string,label:string,confidence:double>>")


def test_annotation_report(spark):
    report = annotation.qa_report(items(spark))
    assert report["num_items"] == 4 and report["needs_adjudication"] == 2
    assert report["mean_agreement"] == round((0.6667 + 0.3333 + 1.0 + 0.0) / 4, 4)
    assert report["annotator_accuracy"] == {"a": 1.0, "b": 0.5, "c": 0.0}
    assert report["annotator_vs_consensus_kappa"] == {"a": 1.0, "b": 1.0, "c": 0.0} and "fleiss_kappa" not in report
    three = annotation.explode_items(items(spark))
    got = {r["item_id"]: tuple(r)[1:] for r in annotation.consensus(three).collect()}
    assert got["i1"] == ("k", 0.6667, 3, False) and got["i2"] == (None, 0.3333, 3, True)
    flagged = {r["annotator_id"]: r["flagged"] for r in annotation.annotator_report(three).collect()}
    assert flagged == {"a": False, "b": True, "c": True}


def test_fleiss_and_alpha(spark):
    labels = [list("kkd"), list("dkx"), list("kkk")]
    df = frame(spark, [(str(i), x) for i, xs in enumerate(labels) for x in xs], "item_id string, label string")
    p = sum((sum(xs.count(k) ** 2 for k in set(xs)) - 3) / 6 for xs in labels) / 3
    every = sum(labels, [])
    pe = sum((every.count(k) / 9) ** 2 for k in set(every))
    assert annotation.fleiss_kappa(df).first()[0] == round((p - pe) / (1 - pe), 4)
    do = sum(x != y for xs in labels for x, y in itertools.combinations(xs, 2)) / 9
    de = 1 - sum(every.count(k) * (every.count(k) - 1) for k in set(every)) / 72
    assert annotation.krippendorff_alpha_pooled(df).first()[0] == round(1 - do / de, 4)
    with pytest.raises(Exception, match="equal number"):
        annotation.fleiss_kappa(df.unionByName(frame(spark, [("9", "k")], "item_id string, label string"))).collect()
    same = frame(spark, [("1", "k"), ("1", "k")], "item_id string, label string")
    single = frame(spark, [("1", "k"), ("2", "d")], "item_id string, label string")
    assert annotation.fleiss_kappa(same).first()[0] == annotation.krippendorff_alpha_pooled(same).first()[0] == 1.0
    assert annotation.krippendorff_alpha_pooled(single).first()[0] == 0.0 and annotation.fleiss_kappa(single.limit(0)).first()[0] == 0.0


def test_preferences(spark):
    rows = [(1, "p", "A", "B"), (2, "p", "B", "C"), (3, "p", "C", "A"), (4, "q", "A", " A "), (5, "p", "A", "B"), (6, "r", "A", "B"), (7, "r", "B", "A"), *[(10 + i, "long", f"n{i}", f"n{i + 1}") for i in range(30)]]
    df = frame(spark, rows, "ord long, prompt string, chosen string, rejected string")
    report, clean = annotation.preference_report(df)
    assert report == {"total": 37, "clean": 35, "cyclic_prompts": 2, "issues": {"chosen_equals_rejected": 1, "duplicate_pair": 1, "cyclic_preferences": 2}}
    assert clean.count() == 35 and {r["prompt"] for r in annotation.cyclic_prompts(clean).collect()} == {"p", "r"}


def test_speech(spark):
    rows = [(0, "Good words here", 2.0, "hi", "s1"), (1, "good  words here", 2.0, "hi", "s2"), (2, " ", 2.0, "hi", "s"), (3, "fine", 0.1, None, "s"), (4, "fine", 31.0, None, None), (5, "x" * 100, 1.0, "ta", ""), (6, "...", 1.0, "ta", "s"), (7, "no duration", None, None, "")]
    got = speech.curate(frame(spark, rows, "ord long, transcript string, duration_sec double, language string, speaker_id string"))
    assert {r["ord"]: r["drop_reason"] for r in got.collect()} == {0: None, 1: "duplicate_transcript", 2: "empty_transcript", 3: "too_short(0.1s)", 4: "too_long(31.0s)", 5: "chars_per_sec_high(100.0)", 6: "too_few_words", 7: None}
    kept = got.filter("drop_reason is null")
    assert speech.total_stats(kept).first().asDict() == {"num_utterances": 2, "total_hours": 0.0006, "num_speakers": 1, "num_languages": 2}
    assert {r["reason"]: r["count"] for r in speech.curation_summary(got).collect()}["too_short"] == 1


def test_synthetic(spark):
    rows = [(0, "s1", "Name a river.", "", "Ganga"), (1, "s2", "please name a river.", "", "Ganga"), (2, "s3", "", "", "x")]
    seeds = frame(spark, rows, "ord long, id string, instruction string, input string, output string")
    made = {r["instruction"]: r for r in synthetic.build(seeds, 5).collect()}
    assert "Can you name a river." in made and "Please name a river." not in made and "Name a river." not in made
    assert made["Can you name a river."]["seed_id"] == "s1" and made["Can you name a river."]["id"].startswith("syn-") and "Please please name a river." in made
    checks = frame(spark, [("", "x"), ("a", " "), ("Same ", "same"), ("a", "y"), ("ask", "fine")], "instruction string, output string")
    assert [r[0] for r in checks.select(synthetic.instruction_issue()).collect()] == ["empty_instruction", "empty_output", "output_echoes_instruction", "output_too_short", None]
    text = frame(spark, [("i", "", "o"), ("i", "n", "o")], "instruction string, input string, output string").select(synthetic.as_text())
    assert [r[0] for r in text.collect()] == ["i\no", "i\nn\no"]


def test_trajectories(spark):
    rows = [("g", "a", ["t"], [("t",)]), ("", " ", ["t"], [("u",), ("",)]), ("g", "a", [], [("any",)]), ("g", "a", [], [])]
    df = frame(spark, rows, "goal string, final_answer string, available_tools array<string>, steps array<struct<tool:string>>")
    assert [r[0] for r in df.select(synthetic.trajectory_problems()).collect()] == [[], ["empty_goal", "no_final_answer", "step0_undeclared_tool:u", "step1_undeclared_tool:", "step1_empty_tool"], [], ["no_steps"]]


def test_search(spark):
    rows = [("a", "the cat sat on the mat"), ("b", "a dog and a cat"), ("c", "nothing here"), ("d", None), ("e", " The Cat Sat on the mat ")]
    index = search.build_index(frame(spark, rows, "doc_id string, text string"))
    idf = lambda df: math.log(6 / (df + 1)) + 1
    got = [(r["doc_id"], r["score"]) for r in index.search("the CAT the").collect()]
    assert got == [("a", round(4 * idf(2) + idf(3), 4)), ("e", round(4 * idf(2) + idf(3), 4)), ("b", round(idf(3), 4))]
    assert [r["doc_id"] for r in index.exact("THE cat sat on the mat").collect()] == ["a", "e"]
    assert index.size() == 5 and index.search("").count() == index.search("zebra").count() == 0 and index.search("cat", 1).count() == 1


def test_statistics(spark):
    rows = [("a b c", "en", "s"), ("b c d", "hi", "s"), ("", None, "t"), (None, "en", None)]
    df = frame(spark, rows, "text string, language string, source string")
    found = stats.diversity_report(df)
    assert (found["num_documents"], found["num_languages"], found["total_tokens"], found["vocabulary_size"], found["type_token_ratio"], found["avg_doc_tokens"]) == (4, 3, 6, 4, 0.6667, 1.5)
    assert found["language_distribution"] == {"en": 2, "hi": 1, "und": 1} and list(found["language_distribution"])[0] == "en"
    assert found["language_balance"] == round(1.5 / math.log2(3), 4) and found["source_distribution"] == {"s": 2, "t": 1, "unknown": 1}
    empty = stats.diversity_report(df.limit(0))
    assert empty["num_documents"] == empty["total_tokens"] == 0 and empty["type_token_ratio"] == 0.0
    one = df.withColumn("hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    assert stats.dataset_version(one, {"a": 1}) == stats.dataset_version(one.repartition(7), {"a": 1}) != stats.dataset_version(one, {"a": 2})


def test_hashing_cosine_of_close_texts(spark):
    df = frame(spark, [(0, "the quick brown fox jumps over the lazy dog today"), (1, "the quick brown fox jumps over the lazy dogs today"), (2, "entirely different words")], "vec_id long, text string")
    vectors = df.select("vec_id", hashing_embedding()(F.col("text")).alias("embedding"))
    assert {r["vec_id"]: r["parent"] for r in dedup.semantic(vectors).collect()} == {0: None, 1: 0, 2: None}


def test_scale_filter(spark):
    df = frame(spark, [("four good words here friends",), ("too short",), (None,)], "t string")
    assert [r[0] for r in df.select(rules.passes_scale_filter(F.coalesce("t", F.lit("")))).collect()] == [True, False, False]
