"""Quality classification by importance resampling.

Two generative models over hashed n-grams, one of a target (labelled good texts) and one of the raw corpus (all texts),
give each document the log importance weight of its n-grams, log p_target - log p_raw. Keys of log weight plus Gumbel
noise, drawn from a hash of id and weight, are a sample without replacement in proportion to the weights when the top k
are taken. For classification, k is the number of documents whose weight reaches a boundary that the labelled sample
fixes: the weight that best parts good from bad labels while it loses at most ``MOST_LOST`` of the good.

Tokens are runs of letters and digits, or of other visible characters, in lower case; n-grams are tokens and pairs of
neighbours. The raw model counts every document whole. The target is fitted on at most about ``LABELLED`` labelled
documents (chosen by hashed id), a documented bound for fitting; they are also what the boundary is fixed on.

The k-th key is found on the driver from histograms of fixed size over ever smaller ranges, so keys never meet; rows
with equal keys at the boundary all stay. Null or blank text has weight 0. Without good or without bad labels nothing
is rejected. Repeated rows get equal keys. Other columns pass through. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import Numbering, chunks, clear_name, fetched, give_back, in_arrow, written
from loomline.llm.exact_dedup import may_be_in
from loomline.llm.simhash import text_key

BUCKETS = 1 << 16
LABELLED = 20_000
MOST_LOST = 0.002
#: Sightings of each bucket that the models are smoothed with.
PRIOR = 20.0
CACHE_WORDS = 300_000
#: Bytes of text whose n-grams are in memory at a time (a longer text makes a chunk of its own).
CHUNK_BYTES = 1 << 19
#: Scale of the Gumbel noise (1: an exact sample in proportion to the weights).
NOISE = 1.0

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Hashes:
    """Token hashes of white-space words, remembered for up to CACHE_WORDS of them."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.at = Numbering()
        self.hashes, self.lengths = np.empty(0, np.uint64), np.empty(0, np.int64)

    def ngrams(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, bucket) of each n-gram of all texts: all tokens, then all pairs of neighbours."""
        if len(self.at) > CACHE_WORDS:
            self.clear()
        split = [t.decode("utf-8", "replace").lower().split() for t in texts]
        flat = [w for ws in split for w in ws]
        word = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        if new := self.at.take():
            found = [_TOKEN.findall(w) for w in new]
            digest = xxhash.xxh64_intdigest
            self.hashes = np.concatenate((self.hashes, np.array([digest(x) for xs in found for x in xs], np.uint64)))
            self.lengths = np.concatenate((self.lengths, np.array([len(xs) for xs in found], np.int64)))
        n = self.lengths[word]
        ends = np.cumsum(n)
        tokens = self.hashes[np.repeat((np.cumsum(self.lengths) - self.lengths)[word] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        words = np.cumsum([len(ws) for ws in split])
        count = np.diff(np.concatenate(([0], ends))[np.concatenate(([0], words))])  # tokens of each text
        text = np.repeat(np.arange(len(texts), dtype=np.int32), count)
        first = np.flatnonzero(text[1:] == text[:-1])  # tokens whose neighbour is of the same text
        mixed = (tokens[first] ^ (tokens[first] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + tokens[first + 1]
        buckets = np.concatenate((tokens % np.uint64(BUCKETS), (mixed ^ (mixed >> np.uint64(31))) % np.uint64(BUCKETS))).astype(np.int32)
        return np.concatenate((text, text[first])), buckets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, raw, good = Hashes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for part, texts in chunks(batches, "text", max_bytes=CHUNK_BYTES):
        text, buckets = hashes.ngrams(texts)
        raw += np.bincount(buckets, minlength=BUCKETS)
        is_good = np.array([x == 1 for x in part.column(0).to_pylist()], bool)
        good += np.bincount(buckets[is_good[text]], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS), pa.int32()), pa.array(raw), pa.array(good)], ["bucket", "raw", "good"])


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", rows: int = LABELLED) -> DataFrame:
    """labelled_id, quality of about `rows` labelled ids at most; ids with several labels have the worst."""
    known = labels.filter(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("labelled_id")).agg(F.min(quality_col).alias("quality"))
    n = known.count()
    share = int(min(1.0, rows / max(1, n)) * (1 << 20))
    return known.filter(F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 20)) < share)


class Model:
    """Sightings of each bucket in the raw corpus and in the target.

    A document is weighed by the models without its own sightings, so those of the target have no advantage. Both are
    smoothed with PRIOR sightings of each bucket, dealt between them as all sightings are: a bucket that was seen little
    says nothing for or against a text.
    """

    def __init__(self, raw: np.ndarray, good: np.ndarray):
        self.raw, self.good = raw, good
        self.part = good.sum() / max(1, raw.sum())

    def weights(self, text: np.ndarray, buckets: np.ndarray, is_good: np.ndarray) -> np.ndarray:
        """The log importance weights of the texts whose n-grams these are."""
        if not self.part:
            return np.zeros(len(is_good))
        held, times = np.unique(text.astype(np.int64) * BUCKETS + buckets, return_counts=True)
        text, bucket = held // BUCKETS, held % BUCKETS
        good = np.maximum(self.good[bucket] - times * is_good[text], 0)
        raw = np.maximum(self.raw[bucket] - times, 0)
        return np.bincount(text, times * np.log((good + PRIOR * self.part) / (raw + PRIOR) / self.part), len(is_good))


def marked(docs: DataFrame, sample: DataFrame, id_col: str, name: str) -> DataFrame:
    """docs with the label of the documents of the sample, which has about LABELLED rows."""
    label = clear_name(docs, "labelled")
    return docs.join(F.broadcast(sample.select(F.col("labelled_id").alias(label), F.col("quality").alias(name))), F.col(id_col) == F.col(label), "left").drop(label)


def fit(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts over every document. The driver gets BUCKETS rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = fetched(marked(rows, sample, "id", "quality").select("quality", "text").transform(in_arrow, _count, "bucket int, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[found.column(0).to_numpy()], good[found.column(0).to_numpy()] = found.column(1).to_numpy(), found.column(2).to_numpy()
    return Model(raw, good)


def log_weight(spark, text: Column, quality: Column, model: Model) -> Column:
    """The text's log importance weight; only the text and its label, if it is of the target, go to Python."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def weigh(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = Hashes()
        for batch in batches:
            out = []
            for part, texts in chunks(iter([pa.RecordBatch.from_arrays(list(batch), ["text", "good"])]), "text", max_bytes=CHUNK_BYTES):
                is_good = np.array(part.column(1).to_pylist(), bool)
                out.append(np.round(shared.value.weights(*hashes.ngrams(texts), is_good), 6))
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())
        del hashes
        give_back()

    return weigh(text, F.coalesce(quality == 1, F.lit(False)))


def gumbel(*seeds: Column) -> Column:
    """A standard Gumbel draw from the seeds' hash."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*seeds, F.lit(10)), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def boundary(scored: DataFrame, sample: DataFrame, most_lost: float = MOST_LOST) -> float | None:
    """The weight from which labelled documents count as good; None if one class is missing. Reads the bounded sample."""
    rows = scored.join(F.broadcast(sample), F.col("id") == F.col("labelled_id")).select("weight", "quality").toArrow()
    weight, good = rows.column(0).to_numpy(), rows.column(1).to_numpy() == 1
    if good.all() or not good.any():
        return None
    order = np.argsort(weight, kind="stable")
    weight, good = weight[order], good[order]
    # Reject everything under weight[i]: share of the bad caught less share of the good lost.
    lost = np.concatenate(([0], np.cumsum(good)[:-1])) / good.sum()
    caught = np.concatenate(([0], np.cumsum(~good)[:-1])) / (~good).sum()
    distinct = np.concatenate(([True], weight[1:] > weight[:-1]))
    worth = np.where(distinct & (lost <= most_lost), caught - lost, -1)
    best = int(worth.argmax())
    return float((weight[best] + weight[best - 1]) / 2) if best else -np.inf


def kth_key(keys: DataFrame, k: int) -> float:
    """The k-th largest of column key, exactly, by histograms of 4096 bins over ever smaller ranges."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or n == 0:
        return np.inf
    if k >= n:
        return low
    while low < high:
        width = (high - low) / 4096
        if width == 0 or low + width == low:
            break
        inside = keys.filter(F.col("key").between(low, high))
        bins = inside.groupBy(F.least(F.lit(4095), F.floor((F.col("key") - low) / width)).alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for b in bins.orderBy(F.desc("bin")).collect():
            if k <= b["n"]:
                low, high = b["low"], b["high"]
                break
            k -= b["n"]
    return low


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: float = NOISE, label_id: str = "doc_id", quality_col: str = "quality") -> tuple[DataFrame, float, Model, DataFrame]:
    """(id, text_key, weight, key of every row; the key from which rows are kept; the model; the labelled sample)."""
    sample = written(labelled_sample(labels, label_id, quality_col), "resample-labels")
    model = fit(docs, sample, id_col, text_col)
    rows = marked(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")), sample, "id", "quality")
    weighed = rows.select("id", "text_key", log_weight(docs.sparkSession, F.col("text"), F.col("quality"), model).alias("weight"))
    scored = written(weighed.withColumn("key", F.col("weight") + noise * gumbel(F.col("id"), F.col("weight"))), "resample-scores")
    cut = boundary(scored, sample)
    if cut is None:
        return scored, -np.inf, model, sample
    k = scored.filter(F.col("weight") >= cut).count()
    return scored, kth_key(scored, k), model, sample


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: float = NOISE) -> DataFrame:
    """One row per row of docs: doc_id, log_weight, gumbel_key, kept."""
    scored, cut, _, _ = score(docs, labels, id_col, text_col, noise)
    return scored.select(F.col("id").alias("doc_id"), F.col("weight").alias("log_weight"), F.col("key").alias("gumbel_key"), (F.col("key") >= F.lit(float(cut))).alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: float = NOISE) -> DataFrame:
    """The rows of docs that are kept, with all columns. Rows of equal id and text have equal keys and go together.

    A filter of the rejected rows' hashes lets most of the others pass straight; only rows that it may hold are joined.
    """
    scored, cut, _, _ = score(docs, labels, id_col, text_col, noise)
    key, gone, may = (clear_name(docs, x) for x in ("key", "gone", "may"))
    row_key = lambda i, t: F.xxhash64(i, t)
    rejected = scored.filter(F.col("key") < F.lit(float(cut))).select(row_key(F.col("id"), F.col("text_key")).alias(key), F.col("id").alias(f"{gone}_id"), F.col("text_key").alias(f"{gone}_key")).distinct()
    rejected = written(rejected, "resample-rejected")
    keyed = may_be_in(docs.withColumn(key, row_key(F.col(id_col), text_key(F.col(text_col)))), key, rejected.select(key), may)
    same = F.col(id_col).eqNullSafe(F.col(f"{gone}_id")) & (text_key(F.col(text_col)) == F.col(f"{gone}_key"))
    return keyed.filter(~F.col(may)).unionByName(keyed.filter(may).join(rejected.drop(key), same, "left_anti")).select(*docs.columns)
