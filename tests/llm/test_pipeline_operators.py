"""Each operator against a brute-force version on a small table of awkward rows."""

import hashlib
import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm import class_lm, exact_dedup, html_extract, langid, licenses, mixing, packing, quality_rules, resampling, simhash
from loomline.llm.common import n_words

WORDS = "the of and to in a is that it was for on are with as his they be at one have this from or had by hot but some what".split()
RNG = np.random.default_rng(7)


def _text(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("" if r.random() < 0.8 else "ly") for i in r.integers(0, len(WORDS), n))


LONG = _text(30_000, 99)
ROWS = [
    (1, "Hello world this is a text", "en", "a"), (2, "Hello world this is a text", "en", "b"), (3, None, "en", "a"), (4, "", None, "a"),
    (5, " \t\n ", "en", None), (6, LONG, "en", "z"), (7, LONG + " end", "en", "z"), (8, "dup line\ndup line\nother", None, "é"),
    (9, "a b c a b c a b c", "de", "é"), (9, "a b c a b c a b c", "de", "é"), (10, "&&& ### 123 $$$", "de", None), (None, "no id here", "en", "a"),
    (None, "no id here", "en", "a"), (12, "Ünïcödé \x1c ſ K İstanbul", "de", "b"), (13, _text(200, 1), "en", "a"), (14, _text(200, 1) + " changed", "en", "b"),
] + [(20 + i, _text(60 + i, i), "en", f"s{i % 3}") for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names clash with the operators' own."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text")).withColumn("sha", F.lit("x")).withColumn("_sha", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("size", F.lit("s")).withColumn("word", F.lit("w")).repartition(3)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def _plain(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@given(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c é", max_size=12))
@settings(max_examples=60, deadline=None)
def test_bytes_split_is_the_contracts_split(t):
    assert [w.decode() for w in t.encode().split()] == _split(t)


def test_n_words(spark):
    texts = [None, "", " ", "a", " a ", "a\tb\x0bc", "\x1c", "  x", "a  b\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(n_words(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(_split(t)) for t in texts]


def test_exact_groups(docs, empty):
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    got = exact_dedup.exact_groups(docs)
    assert Counter(tuple(r[:5]) for r in got.collect()) == want
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(empty).count() == exact_dedup.exact_dedup(empty).count() == 0


def test_exact_filter_that_is_full_changes_nothing(docs, monkeypatch):
    whole = Counter(tuple(r[:5]) for r in exact_dedup.exact_groups(docs).collect())
    monkeypatch.setattr(exact_dedup, "POSITIONS", 1)
    monkeypatch.setattr(exact_dedup, "_position", lambda key, k, bits: F.lit(5).cast("long"))  # all rows at one position
    got = exact_dedup.exact_groups(docs)
    assert not any(r["straight"] for r in got.collect())
    assert whole == Counter(tuple(r[:5]) for r in got.collect())


def test_exact_filter_marks_what_is_hit_twice(spark):
    keys = spark.createDataFrame([(f"k{i if i % 5 else i % 3}",) for i in range(3000)], "k string").repartition(7)
    bits = 1 << 17
    got = {}
    for r in exact_dedup.repeated_positions(keys, "k", bits).collect():
        got |= {64 * r["word"] + b: 1 for b in range(64) if r["marked"] >> b & 1}
    hits = Counter(r["p"] for r in keys.select(F.explode(F.array(*[exact_dedup._position(F.col("k"), k, bits) for k in range(2)])).alias("p")).collect())
    assert set(got) == {p for p, n in hits.items() if n > 1} and any(n == 1 for n in hits.values())


def test_exact_filter_in_ranges(docs, empty, monkeypatch):
    whole = Counter(tuple(r[:5]) for r in exact_dedup.exact_groups(docs).collect())
    monkeypatch.setattr(exact_dedup, "MOST_BITS", 128)  # 28 rows of 16 bits: four ranges
    got = exact_dedup.exact_groups(docs).collect()
    assert whole == Counter(tuple(r[:5]) for r in got) and any(r["straight"] for r in got)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and sorted((r["text"] or "") for r in kept.collect()) == sorted({r[1] or "" for r in ROWS})
    assert exact_dedup.exact_dedup(empty).count() == 0


def _fingerprint(t):
    w = _plain(t).encode().split()
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, empty):
    rows = ROWS
    got = simhash.simhash_groups(docs).collect()
    fps = [_fingerprint(t) for _, t, *_ in rows]
    up = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.product(range(len(rows)), repeat=2):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                up[i] = up[j] = min(up[i], up[j])
    least = {u: min((r[0] for r, v in zip(rows, up, strict=True) if v == u and r[0] is not None), default=None) for u in up}
    assert Counter(tuple(r) for r in got) == Counter((r[0], f"{f:016x}", least[u]) for r, f, u in zip(rows, fps, up, strict=True))
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.fingerprint(LONG.encode()) != 0


def test_simhash_dedup_judges_rows_by_their_own_text(spark):
    a, b, c = ("alpha beta gamma delta " * 9, "one two three four five " * 9, "red green blue white black " * 9)
    docs = spark.createDataFrame([(1, a, 1), (2, a, 2), (2, b, 3), (3, c, 4), (1, a, 1), (None, c, 5), (None, "x", 6), (None, "X", 7), (4, None, 8), (5, " ", 9)], "doc_id long, text string, source int")
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.simhash_dedup(docs).collect()), key=str)
    null = [x for x in got if x[0] is None]
    assert [x for x in got if x[0] is not None] == [(1, a), (2, b), (3, c), (4, None)] and len(null) == 1 and null[0][1].lower() == "x"


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_simhash_shards_find_every_pair(agree):
    centres = RNG.integers(0, 2**63, 200, dtype=np.uint64)
    points = np.unique(np.concatenate([centres ^ np.bitwise_or.reduce(np.uint64(1) << RNG.integers(0, 64, (k, 200)).astype(np.uint64), 0) for k in range(1, 7)]))
    want = {(i, int(j)) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points[i] ^ points) <= 4) if i < j}
    got = set()
    for m in simhash.block_masks(4, agree):
        key = (points & np.uint64(m)).view(np.int64)
        order = np.argsort(key, kind="stable")
        for a, b in simhash.near(points[order], key[order], 4):
            got |= {(min(x, y), max(x, y)) for x, y in zip(order[a].tolist(), order[b].tolist(), strict=True)}
    assert got == want and len(want) > 500


def test_simhash_large_group_in_a_tree_and_split_over_tasks(spark, monkeypatch):
    centre = 0x0123456789ABCDEF
    close = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)} | {int(x) for x in RNG.integers(0, 2**63, 300)})
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in close], "fp long")
    for hot in (100_000, 200):
        monkeypatch.setattr(simhash, "HOT", hot)
        found = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, len(close))).collect()}
        assert len(found) == 2016 and len(set(found.values())) == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 150)) and len(got) == 91


def test_mixing(docs, empty, monkeypatch):
    got = mixing.curriculum(docs, keep=["doc_id", "source"]).collect()
    size = Counter()
    for _, t, _, s in ROWS:
        size[s] += len(_split(t))
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, total, free = {}, 1.5 * sum(size.values()), set(names)
    while True:
        level = total / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * size[s] or not size[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        total -= sum(2.0 * size[s] for s in over)
        free -= over
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        assert r["position"] is None or 0 <= r["position"] <= r["last_position"] <= 1
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(str, got)) == sorted(map(str, mixing.curriculum(docs.repartition(7), keep=["doc_id", "source"]).collect()))
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r["copies"] for r in got)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)  # sums over sources on two levels
    assert sorted(map(str, got)) == sorted(map(str, mixing.curriculum(docs, keep=["doc_id", "source"]).collect()))
    assert mixing.curriculum(empty).count() == mixing.mixed(empty).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path).collect()
    encoder = packing.WordIds(path).encoder
    want, places = Counter(), defaultdict(list)
    for i, t, *_ in ROWS:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((i, k, 2048 * k, len(p := ids[2048 * k : 2048 * (k + 1)]), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // 2048)))
    assert Counter(tuple(r)[:5] for r in got) == want
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for at in places.values():
        assert [o for o, _ in sorted(at)] == [0, *itertools.accumulate(n for _, n in sorted(at))][:-1] and sum(n for _, n in at) <= 2048
    assert packing.pack(empty, path).count() == 0


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25))
@settings(max_examples=80, deadline=None)
def test_packing_plan(counts):
    runs, opened = packing.plan(counts, 60)
    ranks, bins = defaultdict(list), defaultdict(list)
    used = Counter()
    for length, rank, first, offset in sorted(runs):
        ranks[length].append(rank)
    for length, rank, first, offset in runs:
        later = [r for r in ranks[length] if r > rank]
        for k in range((min(later) if later else counts[length]) - rank):
            bins[first + k].append((offset, length))
            used[length] += 1
    assert used == Counter(counts) and len(bins) == opened
    for at in bins.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 60
    assert opened <= 1.25 * sum(k * n for k, n in counts.items()) / 60 + sum(n for k, n in counts.items() if k > 30) * 0.5 + 1


@given(st.text(alphabet="abAB zé́̌JjK.,;:!?'s t 19_-&|<>\x01 \u0085Σσ中\n", max_size=40))
@settings(max_examples=200, deadline=None)
def test_token_ids_are_the_tokenizers(t):
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")) if not hasattr(test_token_ids_are_the_tokenizers, "w") else test_token_ids_are_the_tokenizers.w
    test_token_ids_are_the_tokenizers.w = words
    assert packing.token_ids([t.encode()], words)[0].tolist() == [*words.encoder.encode(t, add_special_tokens=False).ids, 0]


def _seen(train):
    tokens = [[*_split(_plain(t)), ""] for _, t, *_ in ROWS]
    return tokens, Counter(w for (i, *_), ws in zip(ROWS, tokens, strict=True) if train(i or 0) for w in ws)


@pytest.mark.parametrize(("head", "known"), [(1000, 1000), (8, 30), (3, 3), (0, 0)])
def test_class_lm(docs, empty, head, known):
    """With all words at hand, with most of them met by the join, and with none: counts, classes and scores by plain means."""
    got = class_lm.fit_and_score(docs, F.coalesce(F.col("doc_id"), F.lit(0)) % 5 != 0, head=head, known=known)
    scored = got.docs.collect()
    tokens, seen = _seen(lambda i: i % 5)
    n, v = sum(seen.values()), len(seen)
    want = sorted((str(i), len(ws), sum(w in seen for w in ws), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), 4)) for (i, *_), ws in zip(ROWS, tokens, strict=True))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in scored) == want
    # Every training word has a class; the scores follow from classes and counts alone.
    m, k = got.model, class_lm.K
    rest = {r["word"].decode(): (r["n"], r["class"]) for r in got.words.collect()}
    at_hand = {w.decode(): (int(c), int(o)) for w, c, o in zip(m.known, m.counts, m.of, strict=True)}
    assert len(rest) + len(at_hand) == v and {w: c for w, (c, _) in (rest | at_hand).items()} == dict(seen)
    of = {w: o for w, (_, o) in (rest | at_hand).items()}
    assert of.pop("") == class_lm.END_CLASS and all(0 <= o < class_lm.CLASSES for o in of.values())
    of[""] = class_lm.END_CLASS
    new = lambda w: int(m.endings[class_lm.ending([w.encode()], class_lm.ENDINGS)[0]])
    table, size, once = np.zeros((k, k)), np.zeros(k), np.zeros(k)
    for (i, *_), ws in zip(ROWS, tokens, strict=True):
        if (i or 0) % 5:
            for a, b in itertools.pairwise(["", *ws]):
                table[of[a], of[b]] += 1
                size[of[b]] += 1
    for w, c in seen.items():
        once[of[w]] += c == 1 and w != ""
    share = (table.sum(0) + 1) / (table.sum() + k)
    jump = (table + class_lm.SMOOTHING * share) / (table.sum(1, keepdims=True) + class_lm.SMOOTHING)

    def emission(w):
        if w == "":
            return 1.0
        c = of.get(w, new(w))
        return (seen[w] if w in seen else once[c] + 1) / (size[c] + once[c] + 1)

    plain = sorted((str(i), round(sum(math.log10(jump[of.get(a, new(a)), of.get(b, new(b))] * emission(b)) for a, b in itertools.pairwise(["", *ws])), 5)) for (i, *_), ws in zip(ROWS, tokens, strict=True))
    told = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in scored)
    assert [i for i, _ in told] == [i for i, _ in plain] and np.allclose([x for _, x in told], [x for _, x in plain], atol=1e-4)


def test_class_lm_at_the_edges(docs, empty):
    assert class_lm.fit_and_score(empty, F.lit(True)).docs.count() == 0
    none = class_lm.fit_and_score(docs, F.lit(False)).docs.collect()
    assert len(none) == len(ROWS) and all(r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == 0 and r["score"] <= 0 for r in none)


def test_class_lm_in_small_chunks_and_caches(docs, monkeypatch):
    scores = lambda: sorted((str(r["doc_id"]), round(r["score"], 6)) for r in class_lm.fit_and_score(docs, F.lit(True), head=8, known=20).docs.collect())
    whole = scores()
    for name, value in (("CHUNK_BYTES", 2000), ("COUNT_WORDS", 15), ("BLOCK", 3), ("CONTEXTS", 50)):
        monkeypatch.setattr(class_lm, name, value)
    assert scores() == whole


def test_frequent_words_of_equal_counts(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 7 if i < 100 else 9 if i < 110 else 2) for i in range(400)], "word binary, n long")
    assert len(class_lm.frequent(counts, 65)) == pytest.approx(65, abs=2) and {n for _, n in class_lm.frequent(counts, 65)} == {7, 9}
    assert len(class_lm.frequent(counts, 110)) == 110 and len(class_lm.frequent(counts, 1000)) == 400 and class_lm.frequent(counts, 0) == []


def test_best_classes_raise_the_likelihood_most():
    table = RNG.poisson(6, (9, 9)).astype(float)
    words = [RNG.integers(0, 9, (int(n), 2)) for n in (1, 2, 5, 40)]

    def likelihood(t):
        return class_lm._xlogx(t).sum() - class_lm._xlogx(t.sum(0)).sum() - class_lm._xlogx(t.sum(1)).sum()

    entries = Counter((i, c) for i, w in enumerate(words) for a, b in w.tolist() for c in (a, 9 + b))
    keys = sorted(entries)
    got = class_lm.best_classes(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), np.array([entries[k] for k in keys]), 4, table, 6)
    for w, best in zip(words, got.tolist(), strict=True):
        worth = []
        for j in range(6):  # as best_classes has it: rows and columns apart, each against the table at hand
            rows, cols = table.copy(), table.copy()
            for a, b in w.tolist():
                cols[a, j] += 1
                rows[j, b] += 1
            worth.append(sum((class_lm._xlogx(t) - class_lm._xlogx(table)).sum() for t in (rows, cols)) - sum(class_lm._xlogx(m[j] + len(w)) - class_lm._xlogx(m[j]) for m in (table.sum(0), table.sum(1))))
        assert worth[best] == pytest.approx(max(worth))


def test_best_classes_hold_few_gains_at_a_time(monkeypatch):
    rng = np.random.default_rng(12)
    table = rng.poisson(6, (81, 81)).astype(float)
    words, each = 1500, 160
    word, times = np.repeat(np.arange(words), each), rng.integers(1, 9, words * each)
    code = np.concatenate([np.sort(rng.choice(162, each, replace=False)) for _ in range(words)])
    tracemalloc.start()
    got = class_lm.best_classes(word, code, times, words, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # the gains of all entries are 123 MB
    monkeypatch.setattr(class_lm, "ENTRIES", 1)  # less than a word has
    assert class_lm.best_classes(word, code, times, words, table).tolist() == got.tolist()
    monkeypatch.setattr(class_lm, "ENTRIES", 1 << 40)
    assert class_lm.best_classes(word, code, times, words, table).tolist() == got.tolist()


def test_contexts_of_a_word_in_many_batches_are_summed():
    rng = np.random.default_rng(11)
    seen, batches = defaultdict(Counter), []
    rows = sorted(rng.choice([3, 4, 9], 400).tolist())
    for i in range(0, len(rows), 7):
        some = [(w, sorted(rng.choice(50, 12, replace=False).tolist()), rng.integers(1, 5, 12)) for w in rows[i : i + 7]]
        for w, codes, times in some:
            seen[w].update(dict(zip(codes, times.tolist(), strict=True)))
        batches.append(pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.int32()), pa.array([np.array(x[1], "<u2").tobytes() for x in some], pa.binary()), pa.array([x[2].astype("<u4").tobytes() for x in some], pa.binary())], ["word", "codes", "times"]))
    got = []
    for b in class_lm._sum_contexts(iter(batches)):
        for w, codes, times in zip(*[c.to_pylist() for c in b.columns], strict=True):
            got.append(w)
            assert dict(zip(np.frombuffer(codes, "<u2").tolist(), np.frombuffer(times, "<i8").tolist(), strict=True)) == dict(seen[w])
    assert got == [3, 4, 9] and list(class_lm._sum_contexts(iter([batches[0].slice(0, 0)]))) == []


def test_exchange_never_lowers_the_likelihood():
    table = RNG.poisson(2, (30, 30)).astype(float)
    table[:10, 10:20] += 9

    def likelihood(of):
        onehot = np.eye(of.max() + 1)[of]
        c = onehot.T @ table @ onehot
        return class_lm._xlogx(c).sum() - class_lm._xlogx(c.sum(0)).sum() - class_lm._xlogx(c.sum(1)).sum()

    start = np.concatenate((np.arange(27) % 5, [5, 6, 7]))
    values = [likelihood(start), *[likelihood(class_lm.exchange(table, 27, np.array([5, 6, 7]), 5, k)) for k in (1, 2, 5)]]
    assert values == sorted(values) and values[-1] > values[0]


def test_quality_rules(docs, empty):
    got = quality_rules.cascade(docs, keep=["doc_id"], report=quality_rules.BASE).collect()
    want = Counter()
    for i, t, *_ in ROWS:
        w = _split(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        held = {k for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for k in range(j, j + 3)}
        lines = [x for x in (t or "").split("\n") if _split(x)]
        failed = len(w) < 50 or 100 * len(held) > 50 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(held), failed)] += 1
    assert Counter(tuple(r)[:7] for r in got) == want
    assert all(not r["kept"] for r in got if r["base_failed"])
    verdicts = {tuple(sorted((str(r["doc_id"]), r["kept"]) for r in quality_rules.judge(docs, rules, keep=["doc_id"]).collect())) for rules in (quality_rules.RULES, quality_rules.RULES[::-1])}
    assert len(verdicts) == 1
    assert quality_rules.cascade(empty).count() == 0
    sample = quality_rules.measured(docs)
    assert sum(sample.rejected.values()) == sum(r[1] is not None and len(r[1].encode()) <= quality_rules.SAMPLE_BYTES for r in ROWS) and all(x >= 0 for x in sample.seconds)
    # The second rule rejects most by itself, but nothing that the first lets through.
    rules = quality_rules.RULES[:3]
    order = quality_rules.ordered(quality_rules.Sample((1.0, 1.1, 2.0), {0b011: 50, 0b001: 5, 0b100: 9, 0: 30}), rules)
    assert [r.name for r in order] == [rules[0].name, rules[2].name, rules[1].name]


def test_repeated_words_with_a_large_vocabulary():
    w = np.array([10**9, 2, 3, 7, 10**9, 2, 3])
    assert quality_rules.repeated_words(w) == 6 and quality_rules.repeated_words(w[:2]) == 0


def test_licenses(docs, spark, empty):
    texts = ["All RIGHTS reserved. cc by, CC BY-NC 4.0 Licensed under cc by nc", "general public license " * 300, "the Apache License, Version 2.0", "released under the MIT license", "cc bye all right reserved", "K cc by", None, "", LONG]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("hits", F.lit("h"))
    got = {r["doc_id"]: r for r in licenses.scan(df, keep=["doc_id"]).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _plain(t))
        at = [(k, label) for p, label in licenses.BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    assert [got[i]["labels"] for i in (0, 2, 3, 4)] == ["cc-by,cc-by-nc,reserved", "apache-2.0", "mit", ""]
    assert licenses.scan(docs).count() == len(ROWS) and licenses.scan(empty).count() == 0


def test_viterbi():
    n = RNG.integers(1, 8, 12)
    ends = np.cumsum(n)
    scores = RNG.normal(0, 3, (int(ends[-1]), 3))
    for path, a, b in zip(langid.viterbi(scores, ends - n, ends, 2.0), ends - n, ends, strict=True):
        value = lambda p, s=scores[a:b]: sum(s[t, k] for t, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        assert value(list(path)) == pytest.approx(max(map(value, itertools.product(range(3), repeat=b - a))))


def test_language_spans_and_scripts(spark, empty):
    en, de, ru = "the quick brown fox jumps over this lazy dog and then some", "der schnelle braune Fuchs springt über den faulen Hund und dann", "быстрая лиса прыгает через ленивую собаку и потом"
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(en, "en"), (de, "de"), (ru, "ru")] * 20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.langs == ["de", "en", "ru"]
    tests = [en, de, ru, None, "", "123 !!", f"{en} {en} {de} {de}", "собаку", "ελληνικά"]
    df = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["en", "de", "ru", "und", "und", "und"] and got[7]["lang_pred"] == "ru"
    assert [s["lang"] for s in got[6]["spans"]] == ["en", "de"] and abs(got[6]["spans"][0]["end"] - 24) <= 1
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.train(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_language_labels_by_plain_means(spark):
    """Spans by a plain search for the best path, then language and score from them; long and repeated texts among others."""
    en, de = "the quick brown fox jumps over this lazy dog and then some more words", "der schnelle braune Fuchs springt über den faulen Hund und dann weiter"
    train = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([(en, "en"), (de, "de"), ("la volpe veloce salta sopra il cane", "it")] * 20)], "doc_id long, text string, lang string")
    model = langid.train(train, F.lit(True))
    r = np.random.default_rng(8)
    texts = [" ".join(r.choice((en if r.random() < 0.5 else de).split(), int(r.integers(1, 9)))) + f" {de} {en}" * int(r.integers(0, 3)) for _ in range(40)]
    texts += [texts[0], f"{en} {de} " * 400, "123 the 4!", "fox"]
    words = langid.Words(model)
    told = langid.label([t.encode() for t in texts], words)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(x["lang_pred"], x["score"], [s.asDict() for s in x["spans"]]) for x in langid.identify(df, model).orderBy("doc_id").collect()] == told
    for t, (lang, score, spans) in zip(texts, told, strict=True):
        at = words.look(t.lower().split())
        scores, letters = words.scores[at].astype(float), words.n_letters[at]
        best = scores[0]  # the value of the best path that ends in each language
        for row in scores[1:]:
            best = np.maximum(best, best.max() - langid.SWITCH_PENALTY) + row
        path = [model.langs.index(x["lang"]) for x in spans for _ in range(x["start"], x["end"])]
        value = sum(scores[i, k] for i, k in enumerate(path)) - langid.SWITCH_PENALTY * sum(a != b for a, b in itertools.pairwise(path))
        assert len(path) == len(at) and value == pytest.approx(best.max(), abs=1e-3)
        held = np.bincount(path, letters, len(model.langs))
        pick = model.langs.index(lang)
        assert held[pick] == held.max()
        margin = np.clip(scores.sum(0)[pick] - np.delete(scores.sum(0), pick).max(), -30, 30)
        assert score == pytest.approx(held[pick] / held.sum() / (1 + math.exp(-margin)), abs=1e-4)


def test_stretches_that_skip_the_pass_are_single(monkeypatch):
    """The bound that spares texts the pass never hides a switch."""
    counts = RNG.poisson(1, (3, langid.BUCKETS))
    model = langid.Model(["a", "b", "c"], counts, np.ones((3, len(langid.SCRIPTS))))
    texts = [" ".join("".join(chr(97 + x) for x in RNG.integers(0, 26, 5)) for _ in range(n)).encode() for n in RNG.integers(1, 40, 60)]
    words = langid.Words(model)
    fast = langid.label(texts, words, 6.0)
    slow = []
    for t in texts:
        s = words.scores[words.look(t.decode().split())]
        slow.append(langid.viterbi(s, np.array([0]), np.array([len(s)]), 6.0)[0])
    for (_, _, spans), path, t in zip(fast, slow, texts, strict=True):
        s = words.scores[words.look(t.decode().split())]
        own = np.concatenate([[model.langs.index(x["lang"])] * (x["end"] - x["start"]) for x in spans]).astype(int)
        value = lambda p, s=s: s[np.arange(len(p)), p].sum() - 6.0 * (np.diff(p) != 0).sum()
        assert value(own) == pytest.approx(value(path), abs=1e-3)


def test_html(spark):
    tree = html_extract.trained()
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><nav><a href=x>A</a></nav>'
        '<main><article><header><h1>Head &eacute;&#39;s</h1></header><p>One <b>two</b><br>three &lt;x&gt; a&nbsp;b<p>Short.<div class="ad">Buy now</div><form><label>Mail</label><input></form>'
        '<ul><li>item one<li>item two</ul><script>var a="<p>no</p>";</script><div id="comments"><p>Nice post</p></div></article><aside>side</aside></main><footer>f</footer></body></html><p unfinished'
    )
    assert html_extract.main_text(page, tree) == "Head é's\n\nOne two three <x> a b\n\nShort.\n\nitem one\n\nitem two"
    plain = "<div><p>" + "word " * 30 + "</p><p>Short one.</p><p>" + "more " * 40 + "</p></div><ul><li><a>x</a></li><li><a>y</a></li></ul>"
    assert html_extract.main_text(plain, tree).split("\n\n")[1] == "Short one."
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<article>" + "<p>" + "x " * 50_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_html", F.lit(1)).withColumn("text", F.lit("clash"))
    got = html_extract.extract(df, keep=["page_id", "url"]).collect()
    assert [r["n_chars"] for r in got] == [len(r["text"]) for r in got] and [r["n_chars"] for r in got][2:5] == [0, 0, 0] and got[5]["n_chars"] == 99_999
    assert html_extract.extract(df.limit(0), keep=["page_id"]).count() == 0


@pytest.mark.parametrize(
    ("inside", "kept"),
    [
        ('<ol class="commentlist"><li>Nice</ol>', False), ('<div class="commentary">Our view</div>', True), ('<section id="user-comments">x</section>', False), ('<div role="alert">x</div>', False),
        ('<div class="SideBar"><p>x</div>', False), ("<table><tr><td>cell", True), ('<p style="display:none">x', False), ("<blockquote>quoted</blockquote>", True), ("<textarea>x</textarea>", False),
        ("<button>Go</button>", False), ('<p title="a>b">told</p>', True), ("<!-- x --><p>1 < 2</p>", True), ("<p>AT&T &amp; &#x41;&bogus;", True),
    ],
)
def test_html_parts(inside, kept):
    text = html_extract.main_text(f"<html><body><article><p>Before it.</p>{inside}</article></body></html>", html_extract.trained())
    assert text.startswith("Before it.") and (text != "Before it.") == kept


def test_html_decodes(spark):
    text = html_extract.main_text("<article><p>AT&T &amp; &#x41;&bogus; 1 < 2</p></article>", html_extract.trained())
    assert text == "AT&T & A&bogus; 1 < 2"


def test_tree_fits_its_table():
    rows = html_extract.labelled()
    assert (html_extract.trained().predict(rows[:, :-1]) == rows[:, -1]).mean() > 0.97
    used = set()

    def walk(tree):
        if tree.feature is not None:
            used.add(html_extract.FEATURES[tree.feature])
            walk(tree.low)
            walk(tree.high)

    walk(html_extract.trained())
    assert len(used & set(html_extract.FEATURES[:6])) >= 5


def test_resampling(docs, empty, spark):
    r = np.random.default_rng(3)
    good = [(i, _text(int(r.integers(30, 90)), i), 1) for i in range(120)]
    bad = [(200 + i, " ".join(w + "&&&" for w in _text(40, i).split()), 0) for i in range(40)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int").withColumn("labelled", F.lit(1)).withColumn("weight", F.lit("w"))
    labels = df.filter("doc_id % 2 = 0").select("doc_id", "quality")
    got = {x["doc_id"]: x for x in resampling.classify(df.drop("quality"), labels).collect()}
    assert sum(got[i]["kept"] for i, *_ in good) >= 118 and sum(got[i]["kept"] for i, *_ in bad) <= 2
    kept = resampling.resample(df.drop("quality"), labels)
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(i for i, x in got.items() if x["kept"]) and kept.columns == df.drop("quality").columns
    assert all(x["kept"] for x in resampling.classify(docs, labels.filter("quality = 1")).collect())
    assert resampling.classify(docs, labels).count() == len(ROWS) and resampling.resample(empty, labels).count() == 0


def test_resampling_weights_by_plain_means(docs, spark):
    labels = spark.createDataFrame([(6, 1), (13, 1), (10, 0), (20, 1), (21, 0), (9, 1)], "doc_id long, quality int")
    good = {6, 13, 20, 9}

    def buckets(t):
        tokens = [x for w in (t or "").lower().split() for x in re.findall(r"\w+|[^\w\s]+", w)]
        h = [xxhash.xxh64_intdigest(x.encode()) for x in tokens]
        both = [((a ^ a >> 29) * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in itertools.pairwise(h)]
        return Counter([x % resampling.BUCKETS for x in h] + [(x ^ x >> 31) % resampling.BUCKETS for x in both])

    held = [(i, buckets(t)) for i, t, *_ in ROWS]
    raw, target = Counter(), Counter()
    for i, b in held:
        raw.update(b)
        target.update(b if i in good else {})
    part = sum(target.values()) / sum(raw.values())
    weight = lambda i, b: sum(n * math.log((max(0, target[k] - n * (i in good)) + resampling.PRIOR * part) / (max(0, raw[k] - n) + resampling.PRIOR) / part) for k, n in b.items())
    got = sorted((str(x["doc_id"]), round(x["log_weight"], 3)) for x in resampling.classify(docs, labels).collect())
    assert [i for i, _ in got] == sorted(str(i) for i, _ in held)
    assert np.allclose([x for _, x in got], [x for _, x in sorted((str(i), round(weight(i, b), 3)) for i, b in held)], atol=0.01)


def test_kth_key(spark):
    keys = [float(x) for x in RNG.normal(0, 100, 3000).round(1)] + [7.5] * 40
    df = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 2, 500, 1520, 3039, 3040, 9999):
        assert resampling.kth_key(df, k) == sorted(keys, reverse=True)[min(k, len(keys)) - 1]
    assert resampling.kth_key(df, 0) == math.inf


def test_outputs_replace_columns_of_their_names(docs):
    """And a column named like an operator's own helper is no trouble."""
    names = ["score", "Spans", "lang_pred", "n_words", "labels", "kept", "base_failed", "target", "copies", "position", "_mix_copies", "_text", "_html", "n_chars", "fp", "fingerprint", "quality", "weight", "key", "chunk", "rank", "length", "word", "base"]
    clash = docs.filter("doc_id < 14").withColumns({n: F.lit(-1) for n in names})
    n = clash.count()
    model = langid.train(clash, F.lit(True))
    for df in (
        langid.identify(clash, model), langid.identify(clash, None), quality_rules.cascade(clash, report=quality_rules.BASE), licenses.scan(clash), mixing.curriculum(clash), html_extract.extract(clash, "text"),
        exact_dedup.exact_groups(clash), simhash.simhash_groups(clash), class_lm.fit_and_score(clash, F.lit(True)).docs, resampling.classify(clash, clash.select("doc_id", F.lit(1).alias("quality"))),
    ):
        assert len({c.lower() for c in df.columns}) == len(df.columns) and len(df.collect()) == n
    got = quality_rules.cascade(clash, report=quality_rules.BASE).first()
    assert got["n_words"] >= 0 and got["kept"] in (True, False) and got["_text"] == -1
    for df in (mixing.mixed(clash), exact_dedup.exact_dedup(clash), simhash.simhash_dedup(clash), resampling.resample(clash, clash.select("doc_id", F.lit(1).alias("quality")))):
        assert df.columns == clash.columns and df.collect()[0]["copies"] == -1
    assert packing.pack(clash, public_tokenizers.path("word_bpe_49k.json")).collect()
