"""Streaming forms of the narrow and keep-first operators. An extension: batch tables are the main path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.operators import rules


def clean_stream(docs: DataFrame, text: str = "text", language: str | None = None) -> DataFrame:
    """Normalised documents that pass the filter; stateless."""
    tidy = docs.withColumn(text, X.normalize(F.col(text)))
    return tidy.filter(rules.drop_reason(F.col(text), F.col(language) if language else None).isNull())


def dedup_stream(rows: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key within the delay; state is dropped as the watermark passes."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def counts_stream(rows: DataFrame, by: str, time: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows per window and value."""
    return rows.withWatermark(time, delay).groupBy(F.window(time, window), by).count()
