"""Quality rules as a short-circuit cascade.

Every rule reads a few features of a text. On a bounded sample of texts from all partitions each task measures what the
rules cost and which of them reject a text. The order is built from the first place on: next comes the rule that rejects
most per second of those sample texts that the rules before it let through. A text runs through the rules in that order
and leaves at the first that rejects it, so a feature is computed only for texts that some remaining rule has to see
(features that a report asks for are computed for all). The verdict is that of all rules together and doesn't depend on
the order.

Words are runs of bytes other than ASCII white space. Null is a text without words. Repeated rows are judged alike;
other columns pass through; very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import chunks, clear_name, fetched, in_arrow, without_outputs

#: Texts of a partition's sample that costs and rejections are measured on, and the most bytes one may have.
SAMPLE_ROWS = 50
SAMPLE_BYTES = 1 << 16

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


class Texts:
    """Some texts of a chunk, with their words split once."""

    def __init__(self, texts: list[bytes]):
        self.texts, self._words, self.known = texts, [None] * len(texts), {}

    def words(self, i: int) -> list[bytes]:
        if self._words[i] is None:
            self._words[i] = self.texts[i].split()
        return self._words[i]

    def get(self, name: str, rows: np.ndarray) -> np.ndarray:
        """The feature for these rows; what is known isn't computed again."""
        if name not in self.known:
            self.known[name] = np.zeros(len(self.texts), np.int64), np.zeros(len(self.texts), bool)
        values, have = self.known[name]
        if len(new := rows[~have[rows]]):
            values[new], have[new] = FEATURES[name](self, new), True
        return values[rows]


def _each(f: Callable[[bytes], int]) -> Callable[[Texts, np.ndarray], list[int]]:
    return lambda x, rows: [f(x.texts[i]) for i in rows.tolist()]


def _without(t: bytes, gone: bytes) -> int:
    return len(t) - len(t.translate(None, gone))


def _lines(t: bytes) -> list[bytes]:
    return [x for x in t.split(b"\n") if x.strip()]


def _dup_lines(t: bytes) -> int:
    lines = _lines(t)
    return len(lines) - len(set(lines))


def _line_chars(t: bytes) -> int:
    return sum(len(x.decode("utf-8", "replace")) for x in _lines(t))


def _dup_line_chars(t: bytes) -> int:
    """Code points of lines that an earlier line equals."""
    lines = _lines(t)
    if len(lines) == len(set(lines)):
        return 0
    return sum(len(x.decode("utf-8", "replace")) for x in lines) - sum(len(x.decode("utf-8", "replace")) for x in set(lines))


def repeated_words(w: np.ndarray, width: int = 3) -> int:
    """How many of the word numbers w lie in windows of the width that occur at least twice."""
    n = len(w) - width + 1
    if n < 2:
        return 0
    code = w[:n]
    for k in range(1, width):  # ranks of pairs, then of triples: exact for any vocabulary
        base = int(w.max()) + 1
        if int(code.max()) >= (1 << 62) // base:
            code = np.unique(code, return_inverse=True)[1]
        code = code * base + w[k : n + k]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    twice = np.zeros(n, bool)
    twice[1:] |= same
    twice[:-1] |= same
    held = np.zeros(len(w), bool)
    at = order[twice]
    for k in range(width):
        held[at + k] = True
    return int(held.sum())


def _repeat_words(x: Texts, rows: np.ndarray) -> list[int]:
    out = []
    for i in rows.tolist():
        number: dict[bytes, int] = {}
        out.append(repeated_words(np.fromiter((number.setdefault(w, len(number)) for w in x.words(i)), np.int64, len(x.words(i)))))
    return out


FEATURES: dict[str, Callable[[Texts, np.ndarray], list[int]]] = {
    "n_words": lambda x, rows: [len(x.words(i)) for i in rows.tolist()],
    "word_chars": _each(lambda t: len(t.decode("utf-8", "replace")) - _without(t, _SPACE)),
    "n_symbols": _each(lambda t: _without(t, SYMBOLS)),
    "n_dup_lines": _each(_dup_lines),
    "line_chars": _each(_line_chars),
    "dup_line_chars": _each(_dup_line_chars),
    "n_repeat_words": _repeat_words,
    "n_upper": _each(lambda t: _without(t, _UPPER)),
    "n_lower": _each(lambda t: _without(t, _LOWER)),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule rejects where fails, given the arrays of its features, is true. Base rules are the contract's."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., np.ndarray]
    base: bool = False


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50, base=True),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 50 * n, base=True),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > 3 * n),
    Rule("repeated_lines", ("line_chars", "dup_line_chars"), lambda n, d: 10 * d > 3 * n),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 20 * n)),
    Rule("shouting", ("n_upper", "n_lower"), lambda u, w: (u > 2 * w) & (u > 50)),
)


@dataclass(frozen=True)
class Sample:
    """Seconds per text of each rule, and the number of texts by the set of rules that reject them (bit k: the k-th rule)."""

    seconds: tuple[float, ...]
    rejected: dict[int, int]


def measured(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> Sample:
    """Each task measures the first `rows` texts of at most SAMPLE_BYTES that its partition has, and reads no further.

    The driver gets a row per rule and per set of rules that reject a text. The sample settles the order of rules only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        for batch in batches:
            texts += [t.encode() for t in batch.column(0).slice(0, rows - len(texts)).to_pylist()]
            if len(texts) >= rows:
                break
        masks, seconds = np.zeros(len(texts), np.int64), []
        for k, r in enumerate(rules):
            x, every = Texts(texts), np.arange(len(texts))
            began = time.perf_counter()
            bad = r.fails(*[x.get(f, every) for f in r.needs]) if texts else masks
            seconds.append(time.perf_counter() - began)
            masks |= np.where(bad, 1 << k, 0)
        held, n = np.unique(masks, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([True] * len(rules) + [False] * len(held)), pa.array([*range(len(rules)), *held.tolist()], pa.int64()), pa.array(seconds + [0.0] * len(held)), pa.array([len(texts)] * len(rules) + n.tolist(), pa.int64())], ["cost", "key", "seconds", "n"]
        )

    few = docs.select(F.col(text_col).alias("text")).filter(F.octet_length("text") <= SAMPLE_BYTES)
    found = fetched(few.transform(in_arrow, work, "cost boolean, key long, seconds double, n long").groupBy("cost", "key").agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n"))).to_pylist()
    costs = {r["key"]: r["seconds"] / max(1, r["n"]) for r in found if r["cost"]}
    return Sample(tuple(costs.get(k, 0.0) for k in range(len(rules))), {r["key"]: r["n"] for r in found if not r["cost"]})


def ordered(sample: Sample, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by rejections per second of what the rules before let through, the best first; equal ones as listed."""
    left, order = dict(sample.rejected), []
    rest = list(range(len(rules)))
    while rest:
        worth = {k: sum(n for mask, n in left.items() if mask >> k & 1) / max(sample.seconds[k], 1e-9) for k in rest}
        best = max(rest, key=lambda k: worth[k])
        order.append(rules[best])
        rest.remove(best)
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return tuple(order)


def judge(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", keep: list[str] | None = None, report: tuple[str, ...] = ()) -> DataFrame:
    """The columns in keep (default: all) with the features in report, base_failed and kept, which replace columns of these names."""
    keep = without_outputs(docs.columns if keep is None else keep, (*report, "base_failed", "kept"))
    held = clear_name(docs, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, held):
            x, every = Texts(texts), np.arange(len(texts))
            base_failed, kept = np.zeros(len(texts), bool), np.ones(len(texts), bool)
            told = [x.get(f, every) for f in report]
            for r in rules:
                # A text that another rule has rejected still meets the base rules, whose outcome is reported.
                rows = np.flatnonzero(~base_failed if r.base and report else kept)
                if not len(rows):
                    continue
                bad = rows[r.fails(*[x.get(f, rows) for f in r.needs])]
                kept[bad] = False
                if r.base:
                    base_failed[bad] = True
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, told), pa.array(base_failed), pa.array(kept)], [f.name for f in out])

    out = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(f, T.LongType()) for f in report], T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])
    return docs.select(*keep, F.col(text_col).alias(held)).transform(in_arrow, work, out)


def cascade(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES, report: tuple[str, ...] = ()) -> DataFrame:
    """judge() with the rules in the order that a sample of docs suggests."""
    return judge(docs, ordered(measured(docs, text_col, rules), rules), text_col, keep, report)
