"""Text functions against plain Python renderings of their rules."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions import language as L
from loomline.functions import text as X
from loomline.functions import vectors as V
from loomline.operators import rules

CHARS = "aB1. \n\t\r,é" + "".join(map(chr, (0xA0, 0x85, 0x1C, 0x2028, 0x2003, 0x3000, 0x200B, 0xFEFF, 0xAD, 0x200C, 0x964, 0x905, 0x93F, 0x995, 0xBA4, 0x301)))


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def random_texts(n, seed=0, size=30):
    import random

    r = random.Random(seed)
    return ["".join(r.choice(CHARS) for _ in range(r.randint(0, size))) for _ in range(n)]


def plain_normal(t, joiners=False):
    t = unicodedata.normalize("NFC", t or "")
    for c in (0x200B, 0xFEFF, 0xAD, *((0x200C, 0x200D) if joiners else ())):
        t = t.replace(chr(c), "")
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = re.sub("[ \t\xa0" + chr(0x2000) + "-" + chr(0x200A) + "]+", " ", t)
    t = re.sub(r"\s+([" + chr(0x964) + chr(0x965) + "])", r"\1", t)
    t = "\n".join(x.strip() for x in t.split("\n"))
    return re.sub("\n{3,}", "\n\n", t).strip()


def test_normalize(spark):
    texts = [None, "", "plain text", "  two  spaces \n\n\n\nline ", "e" + chr(0x301), "tab\there", *random_texts(1500)]
    for joiners in (False, True):
        assert [v[0] for v in values(spark, texts, X.normalize(F.col("t"), joiners))] == [plain_normal(t, joiners) for t in texts]


def test_counts_and_keys(spark):
    texts = ["", "a", "Hello, World 42!", *random_texts(800, 1)]
    got = values(spark, texts, X.word_count(F.col("t")), F.size(X.words(F.col("t"))), X.symbol_count(F.col("t")), X.digit_count(F.col("t")), X.collapse(F.col("t")), X.strip(F.col("t")))
    cat = unicodedata.category
    white = {*"\t\n\x0b\x0c\r \x85\xa0", *map(chr, (0x2028, 0x2003, 0x3000))}
    for t, (n, m, symbols, digits, collapsed, stripped) in zip(texts, got, strict=True):
        words = re.findall("W[WM]*", "".join("W" if cat(c)[0] in "LN" else "M" if cat(c)[0] == "M" else "." for c in t))
        assert n == m == len(words)
        assert symbols == sum(cat(c)[0] not in "LNM" and c not in white for c in t)
        assert digits == sum(cat(c) == "Nd" for c in t)
        assert (collapsed, stripped) == (" ".join(t.split()), t.strip())


def plain_detect(t):
    found, visible = {}, sum(c.isprintable() and not c.isspace() for c in t)
    for c in t:
        for code, r in L.RANGES:
            if re.match("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), r) + "]", c):
                found[code] = found.get(code, 0) + 1
    best = max(found, key=found.get) if found else None
    return (best, round(found[best] / visible, 4)) if best else (None, 0.0)


def test_detect(spark):
    hi, en = chr(0x905), "a"
    texts = ["", "123", "^^^", en + hi, hi + en, "hello world", chr(0x995) * 3 + chr(0x964), chr(0x0D9A), *random_texts(600, 2)]
    assert [tuple(v[0]) for v in values(spark, texts, L.detect(F.col("t")))] == [plain_detect(t) for t in texts]
    assert plain_detect(en + hi)[0] == "en" and plain_detect(hi + en)[0] == "hi"


def test_tag_keeps_what_is_certain(spark):
    rows = [("hello there", "fr", 1.0), ("hello there", "fr", 0.5), (chr(0x905), None, 0.0)]
    df = spark.createDataFrame(rows, "t string, l string, c double").select(L.tag(F.col("t"), F.col("l"), F.col("c")).alias("x")).select("x.*")
    assert [tuple(r) for r in df.collect()] == [("fr", 1.0, None), ("en", 1.0, None), ("hi", 1.0, True)]


def test_grams(spark):
    texts = ["", "ab", "abcd", "abcde", "ab  cd ab cd", "one two three", *random_texts(200, 3)]
    got = values(spark, texts, X.char_shingles(F.col("t"), 4), X.char_ngrams(F.col("t"), 3), X.word_ngrams(F.col("t"), 3))
    for t, (shingles, grams, words) in zip(texts, got, strict=True):
        c, w = " ".join(t.split()), t.split()
        assert set(shingles) == ({c[i : i + 4] for i in range(len(c) - 3)} if len(c) > 4 else {c} - {""}) and len(set(shingles)) == len(shingles)
        assert grams == ([c[i : i + 3] for i in range(len(c) - 2)] if len(c) >= 3 else [c] if c else [])
        assert words == ([" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else [])


def test_anchors_and_keys(spark):
    t = "Visit https://a.b/c?d=1 on 12 May with Ravi and Ab"
    ((found, key, look),) = values(spark, [t], X.anchors(F.col("t")), X.instruction_key(F.col("t")), X.lookup_key(F.lit("  Some TEXT \n")))
    assert set(found) == {"https://a.b/c?d=1", "12", "May", "Ravi", "Visit"} and key == t.lower() and look == "some text"


def test_html_text(spark):
    page = "<html><script>x<b>1</b></script><STYLE>p{}</STYLE><p>One&amp;</p>\n<p>two</p>"
    assert values(spark, [page], X.html_text(F.col("t"))) == [("One&amp; two",)]


def test_embeddings_agree(spark):
    import hashlib

    texts = ["hello world", "ab", "", None, "aaaa"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dense = {r["doc_id"]: r["v"] for r in df.select("doc_id", V.hashing_embedding()(F.col("text")).alias("v")).collect()}
    sparse = {}
    for r in V.embed_sparse(df).collect():
        sparse.setdefault(r["doc_id"], {})[r["bucket"]] = r["weight"]
    for i, t in enumerate(texts):
        assert {k: pytest.approx(w, abs=1e-6) for k, w in sparse.get(i, {}).items()} == {k: w for k, w in enumerate(dense[i]) if w}
    bucket = int(hashlib.md5(b"aaa").hexdigest(), 16) % 256
    assert dense[4][bucket] == 1.0 and not any(dense[2]) and len(dense[2]) == 256


@given(st.text(alphabet="abcd ", max_size=60), st.text(alphabet="abcd ", max_size=60))
@settings(max_examples=40, deadline=None)
def test_shingle_hashes_are_sets(a, b):
    sa, sb = ({x[i : i + 4] for i in range(max(1, len(x) - 3))} if x else set() for x in (a, b))
    ha, hb = V.shingle_hashes(a, 4), V.shingle_hashes(b, 4)
    assert (len(ha), len(hb), len(set(ha.tolist()) & set(hb.tolist()))) == (len(sa), len(sb), len(sa & sb))


def test_minhash_estimates_jaccard(spark):
    import numpy as np

    a, b = np.arange(1, 1001, dtype=np.uint64), np.arange(201, 1201, dtype=np.uint64)
    mix = lambda x: x * np.uint64(0x9E3779B97F4A7C15)
    share = (V.minhash(mix(a), 512) == V.minhash(mix(b), 512)).mean()
    assert abs(share - 800 / 1200) < 0.08 and not V.minhash(a[:0], 8).any()
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 4]), ([], [])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(V.signature_similarity(F.col("a"), F.col("b"))).collect()] == [0.75, 0.0]


def test_drop_reasons(spark):
    line = "the same line again"
    cases = {
        "short": "too_short(<20chars)", "x" * 100_001: "too_long(>100000chars)", "abcdefghij klmnopqrst": "too_few_words(<4)", "a b c d e f g h i j k l": "mean_word_length_too_low",
        "word &&&& %%%% #### word more words": "symbol_ratio_high(0.34)", "abc 1234567890 123 def ghi": "digit_ratio_high(0.50)", "\n".join([line] * 4): "repeated_lines(0.75)",
        "good words make a fine sentence here": None,
    }
    got = values(spark, list(cases), rules.drop_reason(F.col("t"), F.lit("en")), rules.reason_kind(rules.drop_reason(F.col("t"), F.lit("en"))))
    assert [g[0] for g in got] == list(cases.values()) and got[0][1] == "too_short"
    unknown = values(spark, ["good words make a fine sentence here"], rules.drop_reason(F.col("t"), F.lit(None).cast("string")))
    assert unknown == [("unknown_language",)]
    assert rules.configured({"min_chars": 5, "other": 1}).min_chars == 5


def test_profile_and_quality(spark):
    df = spark.createDataFrame([(1, "One two two.\nthree"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[2:] for r in rules.profile(df).collect()}
    assert got[1] == (18, 4, 2, 0.75, 3.5) and got[2] == got[3] == (0, 0, 1, 0.0, 0.0)
    score = values(spark, ["One two two.\nthree", ""], rules.quality(F.col("t"), F.lit("en"), F.lit(1.0)))
    assert score[0][0] == pytest.approx(round(0.3 * 4 / 50 + 0.3 * 3 / 4 + 0.2 * (1 - 2 / 18) + 0.2, 4)) and score[1][0] == 0.0
