"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenized word by word (the tokenizer drops white space, so a text's ids are its words' ids in order;
each distinct word of a chunk is encoded once), closed with an end id and cut into pieces of at most ``capacity`` ids.
Only the counts of each length, a table of ``capacity`` numbers whatever the input, go to the driver, which plans:

1. Index the lengths and the sums of all pairs of lengths. For lengths in falling order, look up what fills the gap
   exactly: the length itself, the pairs of that sum, then the triples (for each single length, the pairs of the rest),
   and consume each combination as often as the available counts allow.
2. Pack what is left by best fit: the length in hand goes to the open sequences with the smallest gap that takes it.

A plan is a list of runs: "the pieces of length l with ranks r, r + 1, ... go to sequences s, s + 1, ... at offset o";
there are a few for each length. Ranks come from the counts of the tasks before, summed on two levels, and the rank within
the task, so no length, however common, meets in one task, and no text or id shuffles.

Null text is empty: a document of the end id alone. Rows that repeat an id are documents of their own. Very long texts
are tokenized whole. Other columns are left out, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import CHUNK_BYTES, Numbering, chunks, in_arrow, written

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task remembers, and words encoded at a time.
CACHE_WORDS = 300_000
ENCODE_WORDS = 2_000
#: Tasks (2 to this power) whose counts are summed together.
GROUP_BITS = 10
#: A control character: a word of its own with one id.
SEPARATOR = "\x01"


def _core(word: bytes) -> tuple[bytes, bytes]:
    """A word in two parts with the same ids: most words recur with another case or other punctuation at the end.

    Only where this is sure: the tokenizer parts ASCII letters and digits from punctuation, and lower-cases anyway.
    """
    core = word.rstrip(b".,;:!?")
    if core and core is not word and core[-1:].isalnum():
        return core.lower() if core.isalnum() else core, word[len(core) :]
    return word.lower() if word.isalnum() else word, b""


def _gather(ids: np.ndarray, begins: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids of the entries at these numbers, one after the other."""
    n = lengths[at]
    ends = np.cumsum(n)
    return ids[np.repeat(begins[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


class WordIds:
    """The ids of words. Many words are encoded as one text, parted by a word whose single id no other word has."""

    def __init__(self, tokenizer_path: str, separator: str = SEPARATOR, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer_path)
        self.is_end = np.zeros(self.encoder.get_vocab_size(), bool)
        self.is_end[[i for t, i in self.encoder.get_vocab().items() if t.endswith(self.encoder.model.end_of_word_suffix or "</w>")]] = True
        self.separator, (self.mark,) = separator, self.encoder.encode(separator, add_special_tokens=False).ids
        self.cache_words = cache_words
        self.clear()

    def clear(self) -> None:
        """Number 0 is the document's end among the words, and no ids among the cores."""
        self.at, self.ids, self.lengths = Numbering([b""]), [np.array([END_ID], np.uint32)], [np.array([1])]
        self.cores, self.core_ids, self.core_lengths = Numbering([b""]), np.empty(0, np.uint32), np.array([0])
        self.core_begins = np.array([0])

    def _joined(self, words: list[bytes], parted: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each word's). parted: with separators; else each word must be one of letters only."""
        texts = [w.decode("utf-8", "replace") for w in words]
        (whole,) = self.encoder.encode_batch_fast([(f" {self.separator} " if parted else " ").join(texts)], add_special_tokens=False)
        ids = np.array(whole.ids, np.uint32)
        if parted:
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(words) - 1:
                return np.delete(ids, marks), np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1
        else:
            ends = np.flatnonzero(self.is_end[ids])  # each word has at least one, so as many as words is one each
            if len(ends) == len(words):
                return ids, np.diff(np.concatenate(([-1], ends)))
        parts = [x.ids for x in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for p in parts for i in p], np.uint32), np.array([len(p) for p in parts])

    def _encode(self, words: list[bytes]) -> None:
        """Adds words to the cores' table."""
        plain = np.array([w.isalpha() or (not w.isascii() and w.decode("utf-8", "replace").isalpha()) for w in words], bool)
        n = np.zeros(len(words), np.int64)
        begins = np.zeros(len(words), np.int64)
        pieces, held = [self.core_ids], len(self.core_ids)
        for rows, parted in ((np.flatnonzero(plain), False), (np.flatnonzero(~plain), True)):
            for i in range(0, len(rows), ENCODE_WORDS):
                some = rows[i : i + ENCODE_WORDS]
                ids, n[some] = self._joined([words[k] for k in some.tolist()], parted)
                begins[some] = held + np.cumsum(n[some]) - n[some]
                pieces.append(ids)
                held += len(ids)
        self.core_ids = np.concatenate(pieces)
        self.core_begins, self.core_lengths = np.concatenate((self.core_begins, begins)), np.concatenate((self.core_lengths, n))

    def look(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers."""
        if len(self.at) > self.cache_words:
            self.clear()
        out = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        if new := self.at.take():
            parts = np.fromiter(map(self.cores.__getitem__, chain.from_iterable(map(_core, new))), np.int64, 2 * len(new))
            if found := self.cores.take():
                self._encode(found)
            self.ids.append(_gather(self.core_ids, self.core_begins, self.core_lengths, parts))
            self.lengths.append(self.core_lengths[parts].reshape(-1, 2).sum(1))
        return out

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each word's)."""
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        return self.ids[0], self.lengths[0]


def token_ids(texts: list[bytes], words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each closed by the end id; number of each text's)."""
    split = [t.split() for t in texts]
    flat: list[bytes] = []
    for ws in split:
        flat += ws
        flat.append(b"")
    at = words.look(flat)
    ids, lengths = words.table()
    ends = np.cumsum(lengths[at])
    last = np.cumsum([len(ws) + 1 for ws in split]) - 1
    return _gather(ids, np.cumsum(lengths) - lengths, lengths, at), np.diff(np.concatenate(([0], ends[last])))


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, cache_words: int = CACHE_WORDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task and the piece's rank among those of its length in the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path, cache_words=cache_words)
        task = TaskContext.get().partitionId()
        before = np.zeros(capacity + 1, np.int64)  # pieces of each length in the chunks before
        for part, texts in chunks(batches, "text", max_bytes=chunk_bytes):
            ids, n = token_ids(texts, words)
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, n[doc] - start)
            place = (np.cumsum(n) - n)[doc] + start
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * (a + b)]) for a, b in zip(place.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            by = length[order]
            new = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc)))) + before[by]
            before += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, np.int64)), pa.array(rank)], [f.name for f in out]
            )

    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "task", "rank")]])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).transform(in_arrow, work, out)


Run = tuple[int, int, int, int]  # length, first rank, first sequence, offset


class PairSums:
    """The pairs a >= b of some lengths by their sum, up to a bound; the largest a first."""

    def __init__(self, lengths: np.ndarray, most: int):
        lengths = np.sort(lengths[lengths < most])[::-1]
        of = [lengths[i:][lengths[i:] <= most - a] for i, a in enumerate(lengths.tolist())]
        larger = np.repeat(lengths, [len(x) for x in of])
        sums = larger + np.concatenate([*of, np.empty(0, lengths.dtype)])
        order = np.argsort(sums, kind="stable")
        self.larger = larger[order]
        self.at = np.searchsorted(sums[order], np.arange(most + 2))

    def of(self, total: int) -> np.ndarray:
        """The larger lengths of the pairs of this sum."""
        return self.larger[self.at[total] : self.at[total + 1]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """(runs that place all pieces, number of sequences); counts has the number of pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used: dict[int, int] = defaultdict(int)
    runs: list[Run] = []
    opened = 0

    def place(lengths: list[int], times: int, first: int, offset: int = 0) -> None:
        for length in lengths:
            runs.append((length, used[length], first, offset))
            used[length] += times
            left[length] -= times
            offset += length

    def open_(lengths: list[int], times: int) -> None:
        nonlocal opened
        place(lengths, times, opened)
        opened += times

    def times(lengths: list[int]) -> int:
        return min(int(left[x]) // lengths.count(x) for x in lengths)

    if left[capacity]:
        open_([capacity], int(left[capacity]))
    pairs = PairSums(np.flatnonzero(left), capacity)
    for long in range(capacity - 1, 0, -1):
        gap = capacity - long
        if left[long] and gap <= long and (n := times([long, gap])):
            open_([long, gap], n)
        if not left[long]:
            continue
        for a in pairs.of(gap).tolist():
            if a <= long and left[a] and left[gap - a] and (n := times([long, a, gap - a])):
                open_([long, a, gap - a], n)
        singles = np.flatnonzero(left[: min(long, gap - 2) + 1])[::-1] if left[long] and gap > 2 else ()
        for a in singles:
            rest = gap - int(a)
            if 3 * a < gap or not left[long]:
                break
            two = pairs.of(rest)
            two = two[two <= a]
            for b in two[(left[two] > 0) & (left[rest - two] > 0)].tolist():
                if left[long] and (n := times([long, int(a), b, rest - b])):
                    open_([long, int(a), b, rest - b], n)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, number of sequences)
    free = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        while left[length]:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                gap = int(fits[0]) + length
                first, n = gaps[gap].pop()
                free[gap] = bool(gaps[gap])
                take = min(n, int(left[length]))
                place([length], take, first, capacity - gap)
                todo = [(gap - length, first, take), (gap, first + take, n - take)]
            else:
                each = capacity // length
                take, more = divmod(int(left[length]), each)
                first = opened
                todo = []
                if take:
                    open_([length] * each, take)
                    todo.append((capacity - each * length, first, take))
                if more:
                    first = opened
                    open_([length] * more, 1)
                    todo.append((capacity - more * length, first, 1))
            for gap, first, n in todo:
                if gap and n:
                    gaps[gap].append((first, n))
                    free[gap] = True
    return runs, opened


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, cache_words: int = CACHE_WORDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each piece with its sequence_id and its offset there.

    cache_words, chunk_bytes: words whose ids a task remembers, and text it handles at a time. They change memory and time only.
    """
    cut = written(pieces(docs, tokenizer_path, id_col, text_col, capacity, cache_words, chunk_bytes), "pack-pieces")
    by_task = written(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs, _ = plan(counts, capacity)
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 4)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # a few runs for each length
    # Pieces of the length in the tasks before: those of whole groups of tasks, then those in the task's own group.
    before = lambda *by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    grouped = by_task.withColumn("group", F.shiftright("task", GROUP_BITS))
    of_groups = grouped.groupBy(F.col("length").alias("length3"), F.col("group").alias("group3")).agg(F.sum("n").alias("n"))
    of_groups = of_groups.select("length3", "group3", F.coalesce(F.sum("n").over(before("length3", order="group3")), F.lit(0)).alias("far"))
    within = grouped.withColumn("near", F.coalesce(F.sum("n").over(before("length", "group", order="task")), F.lit(0)))
    bases = within.join(of_groups.hint("merge"), (F.col("length") == F.col("length3")) & (F.col("group") == F.col("group3"))).select(F.col("length").alias("length2"), F.col("task").alias("task2"), (F.col("near") + F.col("far")).alias("base"))
    # Parquet folds counts of tasks to few bytes, by which Spark would broadcast them: they grow with the tasks.
    ranked = cut.join(bases.hint("merge"), (F.col("length") == F.col("length2")) & (F.col("task") == F.col("task2"))).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            rank = batch.column(5).to_numpy()
            run = runs[np.searchsorted(keys, batch.column(3).to_numpy() << 48 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])], [f.name for f in out])

    out = T.StructType([*ranked.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.transform(in_arrow, work, out)
