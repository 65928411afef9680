"""Joins between texts: benchmark contamination and parallel alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X

#: A gram table of at most this many rows and bytes is broadcast.
BROADCAST_GRAMS = 2_000_000
BROADCAST_BYTES = 256 << 20


def contamination(docs: DataFrame, benchmark: DataFrame, ngram: int = 13, text: str = "text", order: str = "doc_id", bench_id: str = "item_id", bench_text: str = "text", bench_order: str | None = None) -> DataFrame:
    """order, bench_id, ngram of every contaminated document: its earliest shared gram, of the first benchmark (by bench_order, else by id) that has it.

    The benchmark's grams and their bytes are counted before they are broadcast; a larger set joins by gram.
    """
    grams = lambda c: X.word_ngrams(F.lower(F.coalesce(F.col(c), F.lit(""))), ngram)
    known = benchmark.select(F.col(bench_id).alias("bench_id"), F.col(bench_order or bench_id).alias("first"), F.explode(grams(bench_text)).alias("gram")).groupBy("gram").agg(F.min_by("bench_id", "first").alias("bench_id"))
    rows, size = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("gram") + F.octet_length(F.col("bench_id").cast("string"))), F.lit(0))).first()
    known = F.broadcast(known) if rows <= BROADCAST_GRAMS and size <= BROADCAST_BYTES else known
    own = docs.select(F.col(order), F.posexplode(grams(text)).alias("pos", "gram"))
    hits = own.join(known, "gram").groupBy(order).agg(F.min_by(F.struct("bench_id", "gram"), "pos").alias("hit"))
    return hits.select(order, "hit.bench_id", F.col("hit.gram").alias("ngram"))


def without(docs: DataFrame, hits: DataFrame, order: str = "doc_id") -> DataFrame:
    """docs that have no hit."""
    return docs.join(hits.select(order), order, "left_anti")


def alignment_score(a: Column, b: Column, length_ratio_max: float = 2.5) -> Column:
    """0.6 of length likeness and 0.4 of shared anchors (length likeness where neither text has any); 0 for an empty text."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    likeness = F.greatest(F.lit(0.0), 1 - (long / short - 1) / length_ratio_max)
    x, y = X.anchors(a), X.anchors(b)
    shared = F.when((F.size(x) > 0) | (F.size(y) > 0), X.jaccard(x, y)).otherwise(likeness)
    return F.when(short > 0, F.round(0.6 * likeness + 0.4 * shared, 4)).otherwise(F.lit(0.0))


def align(docs: DataFrame, parallel_id: str = "parallel_id", id_col: str = "id", order: str = "doc_id", language: str = "language", text: str = "text", length_ratio_max: float = 2.5) -> DataFrame:
    """Pairs of documents of one parallel id and different languages, the earlier one first."""
    side = lambda s: docs.filter(F.col(parallel_id).isNotNull()).select(F.col(parallel_id).cast("string").alias("pid"), F.col(order).alias(f"{s}_ord"), F.col(id_col).cast("string").alias(f"{s}_id"), F.col(language).alias(f"{s}_language"), F.col(text).alias(f"{s}_text"))
    pairs = side("source").join(side("target"), "pid").filter((F.col("source_ord") < F.col("target_ord")) & ~F.col("source_language").eqNullSafe(F.col("target_language")))
    return pairs.select(
        F.concat_ws("-", F.lit("align"), "pid", "source_id", "target_id").alias("id"),
        F.col("source_id").alias("source_doc_id"),
        F.col("target_id").alias("target_doc_id"),
        F.coalesce("source_language", F.lit("und")).alias("source_language"),
        F.coalesce("target_language", F.lit("und")).alias("target_language"),
        "source_text",
        "target_text",
        alignment_score(F.col("source_text"), F.col("target_text"), length_ratio_max).alias("alignment_score"),
        F.lit("explicit").alias("method"),
    )
