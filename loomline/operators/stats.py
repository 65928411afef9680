"""Corpus aggregates: diversity, balance, manifest counts, stage statistics, quality report, dataset version."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X


def distribution(docs: DataFrame, column: str, missing: str | None = "und", name: str = "value") -> DataFrame:
    """value, count, the most frequent first (ties by value); nulls and empty values count as `missing`, or not at all if that is None."""
    value = F.when(F.length(F.col(column).cast("string")) > 0, F.col(column).cast("string"))
    rows = docs.select((F.coalesce(value, F.lit(missing)) if missing is not None else value).alias(name))
    return rows.filter(F.col(name).isNotNull()).groupBy(name).count().orderBy(F.desc("count"), name)


def entropy_balance(counts: DataFrame, count: str = "count") -> DataFrame:
    """One row: language_balance, the entropy of the counts over its maximum; 0 for one value at most."""
    total = F.sum(count)
    # -sum(p log p) = log N - sum(c log c) / N needs one pass over the counts.
    sums = counts.agg(total.alias("n"), F.sum(F.col(count) * F.log2(F.col(count))).alias("s"), F.count("*").alias("k"))
    return sums.select(F.when(F.col("k") > 1, F.round((F.log2("n") - F.col("s") / F.col("n")) / F.log2("k"), 4)).otherwise(F.lit(0.0)).alias("language_balance"))


def diversity(docs: DataFrame, text: str = "text", language: str = "language") -> DataFrame:
    """One row: documents, languages, balance, tokens, characters, vocabulary, type-token ratio, tokens per document.

    The vocabulary is a distinct count with a map-side combine over words; totals come from the same words in one row
    per document.
    """
    lowered = docs.select(F.coalesce(F.col(language), F.lit("und")).alias("language"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sums = lowered.agg(F.count("*").alias("num_documents"), F.count_distinct("language").alias("num_languages"), F.coalesce(F.sum(X.word_count(F.lower("text"))), F.lit(0)).alias("total_tokens"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total_characters"))
    vocabulary = lowered.select(F.explode(X.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.lit(1).alias("one")).agg(F.count("*").alias("vocabulary_size"))
    balance = entropy_balance(lowered.groupBy("language").count())
    one = lambda df: df.withColumn("_", F.lit(1))  # noqa: E731  single rows, put side by side
    row = one(sums).join(one(vocabulary), "_").join(one(balance), "_").drop("_")
    share = lambda a, b, d: F.when(b > 0, F.round(a / b, d)).otherwise(F.lit(0.0))
    return row.select("*", share(F.col("vocabulary_size"), F.col("total_tokens"), 4).alias("type_token_ratio"), share(F.col("total_tokens"), F.col("num_documents"), 2).alias("avg_doc_tokens"))


def diversity_report(docs: DataFrame, text: str = "text", language: str = "language", source: str = "source") -> dict:
    """The diversity row with both distributions, as a dictionary on the driver (one entry per language and source)."""
    found = diversity(docs, text, language).first().asDict()
    found["language_distribution"] = {r["value"]: r["count"] for r in distribution(docs, language).collect()}
    found["source_distribution"] = {r["value"]: r["count"] for r in distribution(docs, source, "unknown").collect()}
    return found


def stage_stats(audit: DataFrame, stage: str = "drop_stage") -> DataFrame:
    """stage, removed: rows of the audit table by the stage that dropped them; the kept ones count as `kept`."""
    return audit.groupBy(F.coalesce(stage, F.lit("kept")).alias("stage")).agg(F.count("*").alias("removed"))


def quality_report(scored: DataFrame, quality: str = "quality_score") -> DataFrame:
    """documents, avg_quality (4 places), low_quality (under 0.4)."""
    return scored.agg(F.count("*").alias("documents"), F.round(F.coalesce(F.avg(quality), F.lit(0.0)), 4).alias("avg_quality"), F.count_if(F.col(quality) < 0.4).alias("low_quality"))


def funnel(stats: dict[str, int], kept: int) -> list[tuple[str, int]]:
    """(stage, documents) of a run: collected, after the filter, after all duplicates, kept in the end."""
    collected = stats.get("collected", 0)
    filtered = collected - stats.get("filtered_out", 0)
    duplicates = sum(stats.get(f"{k}_duplicates_removed", 0) for k in ("exact", "near", "semantic"))
    return [("collected", collected), ("after filter", filtered), ("after deduplication", filtered - duplicates), ("kept (final)", kept)]


def funnel_table(audit: DataFrame, stage: str = "drop_stage") -> DataFrame:
    """The funnel of an audit table in which kept documents have no stage: stage, documents, in the order of the run."""
    gone = lambda *names: F.count_if(F.coalesce(F.col(stage), F.lit("")).isin(*names))
    n = F.count("*")
    steps = [("collected", n), ("after filter", n - gone("filter")), ("after deduplication", n - gone("filter", "exact", "near", "semantic")), ("kept (final)", F.count_if(F.col(stage).isNull()))]
    return audit.agg(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), count.cast("long").alias("documents")) for i, (name, count) in enumerate(steps)]).alias("f")).select(F.explode("f").alias("f")).select("f.*")


def dataset_version(docs: DataFrame, config: dict, hash_col: str = "hash") -> str:
    """First 16 hex digits of sha256 over all content hashes in order and the configuration.

    Hashes are sorted by the cluster and joined there, a few thousand to a row; the driver feeds the rows to the digest
    one partition at a time, in order.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["".join(batch.column(0).to_pylist())], pa.string())], ["h"])

    digest = hashlib.sha256()
    for row in docs.select(F.coalesce(hash_col, F.lit("")).alias("h")).orderBy("h").mapInArrow(joined, "h string").toLocalIterator():
        digest.update(row["h"].encode())
    digest.update(json.dumps(config, sort_keys=True, default=str).encode())
    return digest.hexdigest()[:16]
