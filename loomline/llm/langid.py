"""Language identification with spans for mixed texts.

A word's script, found by code-point ranges, narrows the languages to those that use the script in the training texts.
Among them every word gets a score per language: the log probability of its character trigrams (with word edges) under
hashed, smoothed trigram counts of the language. A Viterbi pass over the words' scores with a penalty for each switch
labels spans. A document's language is the one whose spans hold the most letters (ties: the higher total score, then the
first language by name); ``score`` is the share of letters in its spans times its logistic margin over the next language.

Texts whose evidence can never repay a switch are known to be one span without the pass: if no stretch of words favours
other languages by more than the penalty, the best path has no switch. The others run the pass side by side.

The model is trained on at most about ``PER_LANG`` whole labelled documents of each language (chosen by hashed id): a
documented bound for fitting, as is that of the ``MOST_LANGS`` most frequent languages. Null or letterless text is ``und`` with score 0 and no spans, as is every text if there is
no training text. Repeated rows are labelled alike; other columns pass through.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import chunks, clear_name, fetched, in_arrow, without_outputs

PER_LANG = 5_000
#: Languages that are learned, the most frequent first; each costs every task a table of counts.
MOST_LANGS = 256
SWITCH_PENALTY = 14.0
BUCKETS = 1 << 17
#: A language uses a script that has at least this share of its training letters.
SCRIPT_SHARE = 0.005
#: Words whose scores a task remembers.
CACHE_WORDS = 300_000
UNDETERMINED = "und"

#: First code point and name of the ranges of scripts; a range ends where the next begins.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"), (0x08A0, "Arabic"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"),
    (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"),
    (0x3200, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0x10000, "Other"), (0x20000, "Han"), (0x40000, "Other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))

_EDGE = 2  # stands for both word edges


class Letters:
    """Which code points are letters (category L) and which belong to words (L or M)."""

    def __init__(self):
        kinds = [unicodedata.category(chr(i))[0] for i in range(0x10000)]
        self.letter = np.array([k == "L" for k in kinds])
        self.word = np.array([k in "LM" for k in kinds])
        self.starts = np.array([a for a, _ in SCRIPT_RANGES])
        self.script = np.array([SCRIPTS.index(n) for _, n in SCRIPT_RANGES])

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.minimum(codes, 0xFFFF)
        letter, word = self.letter[low], self.word[low]
        for i in np.flatnonzero(codes > 0xFFFF).tolist():
            kind = unicodedata.category(chr(int(codes[i])))[0]
            letter[i], word[i] = kind == "L", kind in "LM"
        return letter, word

    def scripts(self, codes: np.ndarray) -> np.ndarray:
        return self.script[np.searchsorted(self.starts, codes, "right") - 1]


def trigrams(words: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigram buckets, begins of each word's trigrams, letters of each word, script of its first letter or -1).

    A word keeps its letters and marks only and is framed by edges; one without any gives no trigram.
    """
    codes = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    edge = codes == 1
    letter, inside = letters.of(codes)
    if edge.sum() != len(words) + 1:  # a word holds the separator itself
        return trigrams([w.replace("\x01", "") for w in words], letters)
    of_word = np.cumsum(edge) - 1
    n_letters = np.bincount(of_word[letter], minlength=len(words))[: len(words)]
    script = np.full(len(words), -1)
    at = np.flatnonzero(letter)[::-1]
    script[of_word[at]] = letters.scripts(codes[at])  # the first letter is written last
    keep = edge | inside
    codes, edge, of_word = np.where(edge, _EDGE, codes)[keep], edge[keep], of_word[keep]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.zeros(len(words), np.int64), n_letters, script
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    whole = ~edge[1:-1]  # a middle on an edge spans two words
    mixed = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
    mixed = (mixed ^ (mixed >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
    grams = ((mixed ^ (mixed >> 13)) % BUCKETS)[whole]
    counts = np.bincount(of_word[1:-1][whole], minlength=len(words))[: len(words)]
    return grams, np.concatenate(([0], np.cumsum(counts)[:-1])), n_letters, script


def _train(langs: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at = Letters(), {x: i for i, x in enumerate(langs)}
        counts = np.zeros((len(langs), BUCKETS), np.int64)
        used = np.zeros((len(langs), len(SCRIPTS)), np.int64)
        for part, texts in chunks(batches, "text"):
            words: dict[str, Counter] = {}
            for lang, t in zip(part.column(1).to_pylist(), texts, strict=True):
                words.setdefault(lang, Counter()).update(t.decode("utf-8", "replace").lower().split())
            for lang, c in words.items():
                if not c:
                    continue
                grams, begins, n_letters, script = trigrams(list(c), letters)
                times = np.fromiter(c.values(), np.int64, len(c))
                lengths = np.diff(np.append(begins, len(grams)))
                counts[at[lang]] += np.bincount(grams, np.repeat(times, lengths), BUCKETS).astype(np.int64)
                known = script >= 0
                used[at[lang]] += np.bincount(script[known], (times * n_letters)[known], len(SCRIPTS)).astype(np.int64)
        k, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[k, b])], ["lang", "bucket", "n"])
        k, b = np.nonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(-1 - b, pa.int32()), pa.array(used[k, b])], ["lang", "bucket", "n"])

    return work


class Model:
    """langs; table: log probability of each trigram bucket by language; uses: which scripts a language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray, used: np.ndarray):
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        self.table = np.log((counts + 0.1) / (total + 0.1 * BUCKETS)).T.astype(np.float32)
        self.uses = used >= SCRIPT_SHARE * np.maximum(1, used.sum(1, keepdims=True))


def train(docs: DataFrame, train_if: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = PER_LANG) -> Model | None:
    """A model of the labelled rows that train_if selects; None if there are none. The driver gets one fixed-size table."""
    rows = docs.filter(train_if & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()}
    langs = sorted(sizes)
    if not langs:
        return None
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(min(1.0, per_lang / sizes[k]) * (1 << 20))))])
    chosen = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")])
    found = fetched(chosen.select("text", "lang").transform(in_arrow, _train(langs), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    lang, bucket, n = (found.column(i).to_numpy() for i in range(3))
    counts, used = np.zeros((len(langs), BUCKETS), np.int64), np.zeros((len(langs), len(SCRIPTS)), np.int64)
    gram = bucket >= 0
    counts[lang[gram], bucket[gram]] = n[gram]
    used[lang[~gram], -1 - bucket[~gram]] = n[~gram]
    return Model(langs, counts, used)


class Words:
    """Scores of words by language, remembered for up to CACHE_WORDS of them."""

    def __init__(self, model: Model):
        self.model, self.letters = model, Letters()
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.empty((0, len(self.model.langs)), np.float32)
        self.n_letters = np.empty(0, np.int64)

    def look(self, words: list[str]) -> np.ndarray:
        if len(self.at) > CACHE_WORDS:
            self.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.at]
        if new:
            grams, begins, n_letters, script = trigrams(new, self.letters)
            scores = np.zeros((len(new), len(self.model.langs)), np.float32)
            some = np.diff(np.append(begins, len(grams))) > 0
            if some.any():
                scores[some] = np.add.reduceat(self.model.table[grams], begins[some])
            may = self.model.uses.T[script] & (script >= 0)[:, None]
            none = ~may.any(1)
            scores -= scores.max(1, keepdims=True, initial=-1e9, where=may | none[:, None])
            scores = np.where(may, scores, np.float32(-50))
            scores[none] = 0  # no letters, or a script that no language uses: no evidence
            self.at |= {w: len(self.at) + i for i, w in enumerate(new)}
            self.scores, self.n_letters = np.concatenate((self.scores, scores)), np.concatenate((self.n_letters, n_letters))
        at = self.at
        return np.fromiter((at[w] for w in words), np.int64, len(words))


def viterbi(scores: np.ndarray, begins: np.ndarray, ends: np.ndarray, penalty: float) -> list[np.ndarray]:
    """The best labels of each stretch begins[i]:ends[i] (none empty) of scores, all stretches side by side."""
    if not len(begins):
        return []
    order = np.argsort(begins - ends, kind="stable")  # longest first
    first, lengths = begins[order], (ends - begins)[order]
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")  # stretches with at least t + 1 words
    value = scores[first].astype(np.float64)
    came: list[tuple[np.ndarray, np.ndarray]] = []
    label = np.zeros(len(order), np.int64)
    for t in range(1, int(lengths[0])):
        n = int(running[t])
        if n < len(value):
            label[n : len(value)] = value[n:].argmax(1)
            value = value[:n]
        best = value.argmax(1)
        jump = (value[np.arange(n), best] - penalty)[:, None]
        leapt = jump > value
        came.append((best, leapt))
        value = np.where(leapt, jump, value) + scores[first[:n] + t]
    label[: len(value)] = value.argmax(1)
    paths = [np.empty(n, np.int64) for n in lengths.tolist()]
    flat, starts = np.empty(int(lengths.sum()), np.int64), np.concatenate(([0], np.cumsum(lengths)[:-1]))
    for t in range(int(lengths[0]) - 1, -1, -1):
        n = int(running[t])
        flat[starts[:n] + t] = label[:n]
        if t:
            best, leapt = came[t - 1]
            label[:n] = np.where(leapt[np.arange(n), label[:n]], best, label[:n])
    for place, (a, n) in zip(order.tolist(), zip(starts.tolist(), lengths.tolist(), strict=True), strict=True):
        paths[place] = flat[a : a + n]
    return paths


def label(texts: list[bytes], words: Words, penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text; spans have start and end (exclusive) word numbers."""
    langs = words.model.langs
    split = [t.decode("utf-8", "replace").lower().split() for t in texts]
    at = words.look([w for ws in split for w in ws])
    ends = np.cumsum([len(ws) for ws in split])
    begins = ends - [len(ws) for ws in split]
    scores, n_letters = words.scores[at], words.n_letters[at]
    out: list[tuple[str, float, list[dict]]] = [(UNDETERMINED, 0.0, [])] * len(texts)
    sums = np.concatenate((np.zeros((1, len(langs))), np.cumsum(scores, 0, dtype=np.float64)))
    total = sums[ends] - sums[begins]
    letters = np.concatenate(([0], np.cumsum(n_letters)))
    some = np.flatnonzero(letters[ends] > letters[begins])
    if not len(some):
        return out
    best = total.argmax(1)
    # Gain of the best other language over the text's best at each word; a text's first word also resets the sum.
    of = np.repeat(np.arange(len(texts)), ends - begins)
    rows = np.arange(len(of))
    own = scores[rows, best[of]]
    others = scores.copy()
    others[rows, best[of]] = -np.inf
    gain = (others.max(1) - own).astype(np.float64) if len(langs) > 1 else np.full(len(of), -1.0)
    gain[begins[begins < ends]] -= 1e7
    run = np.cumsum(np.maximum(gain, -1e7 - 1e4))
    low = np.minimum.accumulate(run)
    low[1:] = np.minimum(low[1:], run[:-1])
    stretch = run - np.concatenate(([0.0], low[:-1]))
    first = begins[begins < ends]
    stretch[first] = gain[first] + 1e7
    most = np.full(len(texts), -np.inf)
    np.maximum.at(most, of, stretch)
    mixed = np.array([d for d in some.tolist() if most[d] > penalty], np.int64)
    paths = dict(zip(mixed.tolist(), viterbi(scores, begins[mixed], ends[mixed], penalty), strict=True))
    for d in some.tolist():
        a, b = int(begins[d]), int(ends[d])
        if d in paths:
            path = paths[d]
            held = np.bincount(path, n_letters[a:b], len(langs))
            cuts = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1])))
            spans = [{"start": int(i), "end": int(j), "lang": langs[path[i]]} for i, j in zip(cuts, np.append(cuts[1:], b - a), strict=True)]
        else:
            held = np.zeros(len(langs))
            held[best[d]] = letters[b] - letters[a]
            spans = [{"start": 0, "end": b - a, "lang": langs[best[d]]}]
        pick = max(range(len(langs)), key=lambda k: (held[k], total[d, k], -k))
        rest = np.delete(total[d], pick)
        margin = float(np.clip(total[d, pick] - rest.max(), -30, 30)) if len(rest) else 30.0
        out[d] = (langs[pick], float(held[pick] / held.sum() / (1 + np.exp(-margin))), spans)
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The columns in keep (default: all; only these and the text are read) with lang_pred, score and spans, which replace columns of these names."""
    keep = without_outputs(docs.columns if keep is None else keep, ("lang_pred", "score", "spans"))
    held = clear_name(docs, "text")
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * languages floats
    found = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
    out = T.StructType([*[docs.schema[c] for c in keep], *found])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for part, texts in chunks(batches, held):
            told = label(texts, words, penalty)
            arrays = [pa.array([x[0] for x in told]), pa.array([x[1] for x in told], pa.float64()), pa.array([x[2] for x in told], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], [*keep, *found.names])

    return docs.select(*keep, F.col(text_col).alias(held)).transform(in_arrow, work, out)
