"""Language-model scoring with Brown class-based bigrams.

A text's tokens are its ASCII-space words in lower case (A-Z) and one end. The model gives a token the probability of
its class after the class before (the first follows an end) times that of the word within its class.

Classes. Every word of the training texts is put into one of ``CLASSES`` classes by exchange: it goes to the class that
most raises the likelihood of all class bigrams. The ``HEAD`` most frequent words are exchanged in turn, sweep after sweep,
until none moves. Then the others are exchanged against those classes, all at once, by the counts of the classes before
and after them: first the rest of the ``KNOWN`` most frequent words, then, against the classes of all these, every rarer
word, in the executors that hold its occurrences. While a neighbour has no class yet, it counts as one of ``TAILS``
placeholders by its ending. The end has a class of its own. A word that no training text has goes to the class in which
most known words of its ending are.

Probabilities. Transitions between all classes are counted over all training tokens and smoothed with the classes' own
frequencies. In a class of N tokens, of whose words h occur once, a word seen n times has n / (N + h + 1), and all unseen
words share (h + 1) / (N + h + 1).

What meets where. Word counts are combined in each task, then by word. KNOWN words travel to the executors. A rarer word
of a chunk of documents is one row with its places and the classes around them; the rows of a word meet once, get its
count and class, and go back to their chunk, so a row is a word's whole chunk and a frequent word never shuffles. Partial
results are written once to the shared folder, so that a lost executor can't mix two runs' chunks. The driver gets tables
of fixed size.

Null text is empty: the end alone. Repeated rows and ids are documents of their own. Very long texts are read whole; other
columns don't matter, whatever their names. Without training tokens every class and word is equally likely. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import Numbering, chunks, drop, fetched, in_arrow, written

HEAD = 1_000
CLASSES = 64
TAILS = 16
KNOWN = 1 << 17
SWEEPS = 12
#: Strength of the smoothing of transitions, in sightings.
SMOOTHING = 20.0
#: Hashed endings by which unseen words find a class.
ENDINGS = 4096
#: Distinct words that a task numbers before it starts anew, and bytes of text that it handles at a time.
COUNT_WORDS = 400_000
CHUNK_BYTES = 8 << 20
#: Rows of rare words, and counts of contexts, that are worked on at a time.
BLOCK = 20_000
CONTEXTS = 4_000_000
#: Entries whose gains are held at a time (a row of CLASSES numbers each, a few times over), and bytes of class sequences scored at a time.
ENTRIES = 1 << 14
SCORE_BYTES = 1 << 20
#: The end token; no word is empty. Its number is 0, its class END_CLASS.
END = b""
END_CLASS = CLASSES
K = CLASSES + 1
#: Codes of rare words in a chunk's class sequence until they have a class, and of unseen words of class c: UNSEEN + c.
RARE = 255
UNSEEN = K


def ending(words: list[bytes], size: int) -> np.ndarray:
    """A hash of the words' last two bytes, below size."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w[-2:], 7) % size for w in words), np.int64, len(words))


def flat_tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(tokens of all texts, one after the other; number of each text's)."""
    split = [t.lower().split() for t in texts]
    flat: list[bytes] = []
    for ws in split:
        flat += ws
        flat.append(END)
    return flat, np.fromiter((len(ws) + 1 for ws in split), np.int64, len(split))


class Codes:
    """Numbers of words, the known first, and a code for each; new ones get theirs from code_of."""

    def __init__(self, known: list[bytes], codes: np.ndarray, code_of: Callable[[list[bytes]], np.ndarray]):
        self.known, self.base, self.code_of = known, codes, code_of
        self.clear()

    def clear(self) -> None:
        self.at, self.codes = Numbering(self.known), self.base

    def look(self, flat: list[bytes]) -> np.ndarray:
        if len(self.at) > len(self.known) + COUNT_WORDS:
            self.clear()
        numbers = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        if new := self.at.take():
            self.codes = np.concatenate((self.codes, self.code_of(new)))
        return numbers


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """values from each cut to the next, as binaries."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all binaries, one after the other; number of each one's). Null counts as empty."""
    width = np.dtype(kind).itemsize
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) // width
    data = b"".join(x for x in column.to_pylist() if x)
    return (np.frombuffer(data, kind) if data else np.empty(0, kind)), sizes


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = Codes([END], np.zeros(1, np.int8), lambda new: np.zeros(len(new), np.int8))
    counts = np.zeros(1, np.int64)

    def told() -> pa.RecordBatch:
        words = list(seen.at)
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i in at.tolist()], pa.binary()), pa.array(counts[at])], ["word", "n"])

    for _, texts in chunks(batches, "text", max_bytes=CHUNK_BYTES):
        if len(seen.at) > COUNT_WORDS:
            yield told()
            seen.clear()
            counts = np.zeros(1, np.int64)
        more = np.bincount(seen.look(flat_tokens(texts)[0]), minlength=len(seen.at))
        more[: len(counts)] += counts
        counts = more
    yield told()


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n of all tokens of column text."""
    return written(texts.transform(in_arrow, _count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, `most` at most, the first first.

    Bounds come from histograms of fixed size, first of the counts' logarithms, then, in the range in which the bound
    falls, of the counts, then of the hashes of the words of one count: a sort with a limit would send the driver `most`
    rows of every partition. Of the words of the last count some hashes' are in, as many as fit.
    """
    chosen, left = F.lit(False), most
    inside = F.lit(True)
    for bins in (F.floor(F.log2("n") * 64), F.col("n"), F.pmod(F.xxhash64("word"), F.lit(65_536))):
        last = None
        for r in counts.filter(inside).groupBy(bins.alias("bin")).agg(F.count("*").alias("words")).orderBy(F.desc("bin")).collect():
            if r["words"] > left:
                last = r["bin"]
                break
            left -= r["words"]
        if last is None:
            chosen = chosen | inside
            break
        chosen, inside = chosen | (inside & (bins > last)), inside & (bins == last)
    rows = counts.filter(chosen).select("word", "n").toArrow()
    return sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))


def _contexts(known: list[bytes], head: int):
    """Per unit (head words by number, the end, the tails) counts of the units after it; per other known word counts of
    the units before it and, from `size` on, after it. Rows: word (unit, or size + number), codes, times."""
    size = head + 1 + TAILS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tails = lambda words: ending(words, TAILS) + head + 1
        seen = Codes(known, np.concatenate(([head], np.arange(head), tails(known[head + 1 :]))).astype(np.int64), tails)
        pairs = np.zeros(size * size, np.int64)
        held: list[np.ndarray] = []

        def rows(words: np.ndarray, codes: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            cuts = np.append(np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))), len(words)) if len(words) else np.zeros(1, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(words[cuts[:-1]], pa.int32()), _binaries(codes.astype("<u2"), cuts), _binaries(times.astype("<u4"), cuts)], ["word", "codes", "times"])

        def told() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return rows(size + keys // (2 * size), keys % (2 * size), times)

        for _, texts in chunks(batches, "text", max_bytes=CHUNK_BYTES):
            numbers = seen.look(flat_tokens(texts)[0])
            units = seen.codes[numbers]
            before = np.concatenate(([head], units[:-1]))
            pairs += np.bincount(before * size + units, minlength=size * size)
            at = np.flatnonzero((numbers > head) & (numbers < len(known)))
            word = (numbers[at] - head - 1) * (2 * size)
            held += [word + before[at], word + size + units[at + 1]]  # an end follows every word
            if sum(map(len, held)) > CONTEXTS:
                yield told()
        if held:
            yield told()
        at = np.flatnonzero(pairs)
        for i in range(0, len(at), 1 << 18):
            some = at[i : i + (1 << 18)]
            yield rows(some // size, some % size, pairs[some])

    return work


def whole_groups(batches: Iterator[pa.RecordBatch], column: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least about `rows` rows, of which no two hold the same value of the column, by which the rows are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows or held[0].column(column)[0] == batch.column(column)[-1]:
            continue
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        by = table.column(column)
        new = np.flatnonzero(pc.not_equal(by.slice(1), by.slice(0, len(by) - 1)).to_numpy(zero_copy_only=False))
        cut = int(new[-1]) + 1
        yield table.slice(0, cut)
        held = [table.slice(cut)]
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def group_numbers(column: pa.Array) -> np.ndarray:
    """0, 1, ... of the groups of equal neighbours."""
    if len(column) < 2:
        return np.zeros(len(column), np.int64)
    return np.concatenate(([0], np.cumsum(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False))))


def _sum_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For partitions sorted by word: a row per word. Of the last word only sums are held, however many rows it has."""
    keys, total = np.empty(0, np.int64), np.empty(0, np.int64)

    def rows(n: int) -> pa.RecordBatch:
        word = keys[:n] >> 16
        cuts = np.append(np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))), n)
        return pa.RecordBatch.from_arrays([pa.array(word[cuts[:-1]], pa.int32()), _binaries((keys[:n] & 0xFFFF).astype("<u2"), cuts), _binaries(total[:n].astype("<i8"), cuts)], ["word", "codes", "times"])

    for batch in batches:
        codes, sizes = _joined(batch.column(1), "<u2")
        if not len(codes):
            continue
        more = np.repeat(batch.column(0).to_numpy().astype(np.int64), sizes) << 16 | codes
        times = np.concatenate((total, _joined(batch.column(2), "<u4")[0]))
        keys, at = np.unique(np.concatenate((keys, more)), return_inverse=True)
        total = np.bincount(at, times, len(keys)).astype(np.int64)
        if done := int(np.searchsorted(keys, keys[-1] >> 16 << 16)):  # the last word may go on
            yield rows(done)
            keys, total = keys[done:], total[done:]
    if len(keys):
        yield rows(len(keys))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, words: int, fixed: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of all rows of the bigram counts: the first `words` are assigned, the others stay as in fixed.

    The likelihood is the sum of x log x over class bigrams less that over both margins.
    """
    of = np.concatenate((np.arange(words) % classes, fixed)).astype(np.int64)
    k = int(of.max(initial=classes - 1)) + 1
    onehot = np.zeros((len(of), k))
    onehot[np.arange(len(of)), of] = 1
    after, before = bigrams @ onehot, bigrams.T @ onehot  # by word: counts of the class after it, and before it
    table = onehot.T @ after
    totals_l, totals_r = bigrams.sum(1), bigrams.sum(0)
    left, right = table.sum(1), table.sum(0)
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            own = int(of[w])
            r, c, both = after[w].copy(), before[w].copy(), bigrams[w, w]
            r[own] -= both
            c[own] -= both
            table[own] -= r
            table[:, own] -= c
            table[own, own] -= both
            left[own] -= totals_l[w]
            right[own] -= totals_r[w]
            # What each class would gain: its row takes r, its column c, its corner both and the self pairs.
            rows = (_xlogx(table + r) - _xlogx(table)).sum(1)
            cols = (_xlogx(table.T + c) - _xlogx(table.T)).sum(1)
            corner = np.diag(table)
            gain = rows + cols - (_xlogx(corner + r) - _xlogx(corner)) - (_xlogx(corner + c) - _xlogx(corner)) + _xlogx(corner + r + c + both) - _xlogx(corner)
            gain -= _xlogx(left + totals_l[w]) - _xlogx(left) + _xlogx(right + totals_r[w]) - _xlogx(right)
            best = int(gain[:classes].argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            table[best] += r
            table[:, best] += c
            table[best, best] += both
            left[best] += totals_l[w]
            right[best] += totals_r[w]
            if best != own:
                moved += 1
                of[w] = best
                after[:, own] -= bigrams[:, w]
                after[:, best] += bigrams[:, w]
                before[:, own] -= bigrams[w]
                before[:, best] += bigrams[w]
        if not moved:
            break
    return of


def best_classes(word: np.ndarray, code: np.ndarray, times: np.ndarray, words: int, table: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class for each of `words` words that most raises the likelihood of the class bigrams in table.

    Entries: word, times, and a code: the class before, or, from len(table) on, the class after; sorted by word, every
    word has some. The words don't see each other, so they are taken a few at a time, of about ENTRIES entries together.
    """
    k = len(table)
    starts = np.searchsorted(word, np.arange(words + 1))
    both = np.concatenate((table[:, :classes], table.T[:, :classes]))  # row: code; column: the class that a word may go to
    base = _xlogx(both)
    once = _xlogx(both + 1) - base

    def best(code: np.ndarray, times: np.ndarray, start: np.ndarray) -> np.ndarray:
        n = np.add.reduceat(np.where(code >= k, 0, times), start)  # as many classes stand before as after
        gain = np.empty((len(code), classes))
        single = times == 1
        gain[single] = once[code[single]]
        more = ~single
        gain[more] = _xlogx(both[code[more]] + times[more, None]) - base[code[more]]
        out = np.add.reduceat(gain, start, axis=0)
        for margin in (table.sum(0)[:classes], table.sum(1)[:classes]):
            out -= _xlogx(margin + n[:, None]) - _xlogx(margin)
        return out.argmax(1)

    found, a = np.empty(words, np.int64), 0
    while a < words:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + ENTRIES, "right")) - 1)
        low, high = starts[a], starts[b]
        found[a:b] = best(code[low:high], times[low:high], starts[a:b] - low)
        a = b
    return found


@dataclass
class Model:
    """By number, the end first: the known words, their counts and classes. By hashed ending: the class of unseen words."""

    known: list[bytes]
    counts: np.ndarray
    of: np.ndarray
    endings: np.ndarray
    tokens: int
    words: int


def fit_known(texts: DataFrame, head: int = HEAD, known: int = KNOWN) -> Model:
    """The model of the most frequent words of column text. The driver gets tables of fixed size."""
    counts = word_counts(texts)
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.filter(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    top = frequent(counts.filter(F.length("word") > 0), known)
    drop(counts)
    words = [END, *[w for w, _ in top]]
    head = min(head, len(top))
    size = head + 1 + TAILS
    kind = "word int, codes binary, times binary"
    found = written(texts.transform(in_arrow, _contexts(words, head), kind).repartition("word").sortWithinPartitions("word").transform(in_arrow, _sum_contexts, kind), "lm-contexts")
    bigrams = np.zeros((size, size))
    units = found.filter(F.col("word") < size).toArrow().combine_chunks()
    for batch in units.to_batches():
        codes, sizes = _joined(batch.column(1), "<u2")
        bigrams[np.repeat(batch.column(0).to_numpy(), sizes), codes] = _joined(batch.column(2), "<i8")[0]
    unit_class = exchange(bigrams, head, np.arange(END_CLASS, K + TAILS), CLASSES)
    onehot = np.zeros((size, K + TAILS))
    onehot[np.arange(size), unit_class] = 1
    table = onehot.T @ bigrams @ onehot

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes = _joined(batch.column(1), "<u2")
            codes = np.where(codes < size, unit_class[codes % size], K + TAILS + unit_class[codes % size])
            best = best_classes(np.repeat(np.arange(len(sizes)), sizes), codes, _joined(batch.column(2), "<i8")[0], len(sizes), table) if len(sizes) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32())], ["word", "class"])

    of = np.zeros(len(words), np.int64)
    of[0] = END_CLASS
    of[1 : head + 1] = unit_class[:head]
    rest = fetched(found.filter(F.col("word") >= size).transform(in_arrow, assign, "word int, class int"))
    of[rest.column(0).to_numpy() - size + head + 1] = rest.column(1).to_numpy()
    votes = np.zeros((ENDINGS, CLASSES), np.int64)
    np.add.at(votes, (ending(words[1:], ENDINGS), of[1:]), 1)
    votes += votes.sum(0) * (votes.sum(1, keepdims=True) == 0)  # an ending that no known word has: the largest class
    drop(found)
    return Model(words, np.array([ends, *[n for _, n in top]], np.int64), of, votes.argmax(1), int(n_tokens), int(n_words))


#: A row is a document (seq: a class for each token), or a rare word of a chunk (places, and the codes around those in
#: training documents), or a task's counts of class bigrams.
_PARTS = "doc_id {kind}, chunk long, doc int, train boolean, n_known long, base double, logs double, seq binary, word binary, places binary, around binary, pairs binary"


def _partial(model, schema: T.StructType):
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        known = len(m.known)
        size = K + TAILS
        seen = Codes(m.known, m.of, lambda words: ending(words, TAILS) + K)
        log_base, log_n = np.log10(m.counts + 1), np.log10(np.maximum(m.counts, 1))
        have = m.counts > 0
        pairs = np.zeros(size * size, np.int64)
        task = TaskContext.get().partitionId() << 32
        kinds: list = []

        def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kind)) for c, kind in zip(names, kinds, strict=True)], names)

        for part, texts in chunks(batches, "text", max_bytes=CHUNK_BYTES):
            kinds = kinds or [part.column(0).type, pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 5]
            flat, n = flat_tokens(texts)
            numbers = seen.look(flat)
            codes = seen.codes[numbers]
            doc = np.repeat(np.arange(len(n)), n)
            train = part.column(1).to_numpy(zero_copy_only=False).astype(bool)[doc]
            before = np.concatenate(([END_CLASS], codes[:-1]))  # a document follows the end of another, or an end of its own
            pairs += np.bincount((before * size + codes)[train], minlength=size * size)
            seldom = numbers >= known
            safe = np.where(seldom, 0, numbers)
            sums = [np.bincount(doc, np.where(seldom, 0, x[safe]), len(n)) for x in (have, log_base, log_n)]
            cuts = np.concatenate(([0], np.cumsum(n)))
            chunk = lambda k: pa.array(np.full(k, task))  # noqa: E731, B023
            yield rows(
                len(n), doc_id=part.column(0), chunk=chunk(len(n)), doc=pa.array(np.arange(len(n)), pa.int32()), train=part.column(1), n_known=pa.array(sums[0].astype(np.int64)), base=pa.array(sums[1]), logs=pa.array(sums[2]),
                seq=_binaries(np.where(seldom, RARE, codes).astype(np.uint8), cuts),
            )
            at = np.flatnonzero(seldom)
            if len(at):
                at = at[np.argsort(numbers[at], kind="stable")]
                new = np.flatnonzero(np.concatenate(([True], numbers[at[1:]] != numbers[at[:-1]])))
                taught = train[at]
                around = np.column_stack((before[at], codes[at + 1])).astype(np.uint8)[taught]  # an end follows every word
                yield rows(
                    len(new), chunk=chunk(len(new)), word=pa.array([flat[i] for i in at[new].tolist()], pa.binary()), places=_binaries(at.astype("<u4"), np.append(new, len(at))),
                    around=_binaries(around.reshape(-1), 2 * np.concatenate(([0], np.cumsum(taught)))[np.append(new, len(at))]),
                )
            task += 1
        if kinds:
            yield rows(1, pairs=pa.array([pairs.tobytes()], pa.binary()))

    return work


def _total(rows: DataFrame, k: int) -> np.ndarray:
    """The sum of the tasks' tables of longs in column pairs, k numbers each; summed in the executors, then on the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = rows.filter(F.col("pairs").isNotNull()).select("pairs").transform(in_arrow, work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = fetched(found)
    total = np.zeros(k)
    total[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return total


def _classify(table: np.ndarray, endings: np.ndarray, tell_word: bool):
    """For rows of rare words sorted by word: the word's training count and class, and whether it is the word's first row."""
    size = len(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 0, BLOCK):
            group = group_numbers(batch.column(0))
            first = np.concatenate(([True], group[1:] != group[:-1]))
            words = batch.column(0).take(pa.array(np.flatnonzero(first))).to_pylist()
            codes, sizes = _joined(batch.column(3), "u1")
            of = np.repeat(group, sizes // 2)
            n = np.bincount(of, minlength=len(words))
            classes = endings[ending(words, ENDINGS)]
            keys, times = np.unique(np.concatenate((of, of)) * (2 * size) + np.concatenate((codes[0::2], size + codes[1::2].astype(np.int64))), return_counts=True)
            seen = np.flatnonzero(n)
            if len(seen):
                rank = np.zeros(len(words), np.int64)
                rank[seen] = np.arange(len(seen))
                classes[seen] = best_classes(rank[keys // (2 * size)], keys % (2 * size), times, len(seen), table)
            told = [batch.column(1), batch.column(2), pa.array(n[group]), pa.array(classes[group], pa.int32()), pa.array(first)]
            yield pa.RecordBatch.from_arrays([*([batch.column(0)] if tell_word else []), *told], [*(["word"] if tell_word else []), "chunk", "places", "n", "class", "first"])

    return work


def _fill(schema: T.StructType):
    """Per chunk (rows are sorted by it): documents with their whole class sequence; at the end the task's counts.

    The counts are of class bigrams, then of words seen once by class.
    """
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, once = np.zeros(K * K, np.int64), np.zeros(K, np.int64)
        kind = None
        for batch in whole_groups(batches, 0, BLOCK):
            kind = batch.column(1).type
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for a, b in _runs(column["chunk"].to_numpy()):
                some = {c: x.slice(a, b - a) for c, x in column.items()}
                is_doc = some["doc"].is_valid()
                docs = {c: x.filter(is_doc) for c, x in some.items()}
                words = {c: x.filter(pc.invert(is_doc)) for c, x in some.items()}
                order = pa.array(np.argsort(docs["doc"].to_numpy()))
                docs = {c: x.take(order) for c, x in docs.items()}
                seq, sizes = _joined(docs["seq"], "u1")
                seq = seq.copy()
                places, times = _joined(words["places"], "<u4")
                n, of = words["n"].to_numpy().astype(np.int64), words["class"].to_numpy().astype(np.int64)
                seq[places] = np.repeat(np.where(n > 0, of, UNSEEN + of), times)
                doc = np.searchsorted(np.cumsum(sizes), places, "right")
                more = [np.bincount(doc, np.repeat(x, times), len(sizes)) for x in (n > 0, np.log10(n + 1), np.log10(np.maximum(n, 1)))]
                codes = seq.astype(np.int64)
                train = np.repeat(docs["train"].to_numpy(zero_copy_only=False).astype(bool), sizes)
                before = np.concatenate(([END_CLASS], codes[:-1]))
                pairs += np.bincount((before * K + codes)[train], minlength=K * K)
                new = words["first"].to_numpy(zero_copy_only=False).astype(bool) & (n == 1)
                once += np.bincount(of[new], minlength=K)
                yield pa.RecordBatch.from_arrays(
                    [docs["doc_id"], pa.array(sizes.astype(np.int64)), pa.array(docs["n_known"].to_numpy() + more[0].astype(np.int64)), pa.array(docs["base"].to_numpy() + more[1]), pa.array(docs["logs"].to_numpy() + more[2]),
                     _binaries(seq, np.concatenate(([0], np.cumsum(sizes)))), pa.nulls(len(sizes), pa.binary())], names,
                )
        if kind is not None:
            blank = [pa.nulls(1, t) for t in (kind, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array([np.concatenate((pairs, once)).tobytes()], pa.binary())], names)

    return work


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist()
    return list(zip(cuts, [*cuts[1:], len(values)], strict=True))


@dataclass
class Scored:
    """docs: a row for every row. words: word, n, class of every training word beyond model.known. By class: log10 of the
    transitions, of the tokens that emissions are shares of, and of what all unseen words have of them."""

    docs: DataFrame
    words: DataFrame
    model: Model
    transition: np.ndarray
    total: np.ndarray
    unseen: np.ndarray


def fit_and_score(docs: DataFrame, train_if: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, known: int = KNOWN) -> Scored:
    """Learns from the rows that train_if selects; scores every row of docs.

    docs has doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity.
    """
    kind = docs.schema[id_col].dataType
    train = F.coalesce(train_if, F.lit(False))
    model = fit_known(docs.filter(train).select(F.col(text_col).alias("text")), head, known)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # KNOWN words at most
    schema = T._parse_datatype_string(_PARTS.format(kind=kind.simpleString()))
    parts = written(docs.select(F.col(id_col).alias("doc_id"), train.alias("train"), F.col(text_col).alias("text")).transform(in_arrow, _partial(shared, schema), schema), "lm-parts")
    size = K + TAILS
    table = _total(parts, size * size).reshape(size, size)
    rare = parts.filter(F.col("word").isNotNull()).select("word", "chunk", "places", "around").repartition("word").sortWithinPartitions("word")
    told = "chunk long, places binary, n long, class int, first boolean"
    met = rare.transform(in_arrow, _classify(table, model.endings, False), told)
    words = rare.transform(in_arrow, _classify(table, model.endings, True), f"word binary, {told}").filter("first and n > 0").select("word", "n", "class")
    own = parts.filter(F.col("doc").isNotNull()).select("chunk", "doc_id", "doc", "train", "n_known", "base", "logs", "seq")
    both = own.unionByName(met, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk")
    out = T.StructType([T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")], *[T.StructField(c, T.DoubleType()) for c in ("base", "logs")], T.StructField("seq", T.BinaryType()), T.StructField("pairs", T.BinaryType())])
    filled = written(both.transform(in_arrow, _fill(out), out), "lm-sequences")
    found = _total(filled, K * K + K)
    once = found[K * K :] + np.bincount(model.of[1:][model.counts[1:] == 1], minlength=K)
    transition, total, unseen = probabilities(found[: K * K].reshape(K, K), once)
    n, v = model.tokens, model.words

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in chunks(batches, "seq", max_bytes=SCORE_BYTES):  # the session's own batches may hold many long sequences
            seq, sizes = _joined(batch.column(5), "u1")
            codes = seq.astype(np.int64)
            new = codes >= UNSEEN
            codes = np.where(new, codes - UNSEEN, codes)
            before = np.concatenate(([END_CLASS], codes[:-1]))
            each = transition[before, codes] - total[codes] + np.where(new, unseen[codes], 0.0)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            tokens = batch.column(1).to_numpy()
            sums = batch.column(4).to_numpy() + np.bincount(doc, each, len(sizes))
            base = batch.column(3).to_numpy() - tokens * np.log10(n + v + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.full(len(sizes), n), pa.int64()), pa.array(base), pa.array(sums), pa.array(10 ** (-sums / tokens))], result.names)

    result = T.StructType([*out.fields[:3], T.StructField("train_tokens", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity")]])
    rows = filled.filter(F.col("seq").isNotNull()).drop("pairs")
    return Scored(rows.transform(in_arrow, score, result), words, model, transition, total, unseen)


def probabilities(table: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 of the transitions; by class, of the tokens that emissions are shares of, and of the unseen words' among them.

    table counts class bigrams, once the words by class that are seen once. The end is never unseen.
    """
    share = (table.sum(0) + 1) / (table.sum() + K)
    transition = np.log10((table + SMOOTHING * share) / (table.sum(1, keepdims=True) + SMOOTHING))
    unseen = np.where(np.arange(K) == END_CLASS, 0.0, once + 1)
    total = np.maximum(table.sum(0) + unseen, 1)
    return transition, np.log10(total), np.log10(np.maximum(unseen, 1))
