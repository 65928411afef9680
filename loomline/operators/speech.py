"""Speech manifests: filter, transcript deduplication, statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.operators.dedup import keep_first
from loomline.operators.rules import reason_kind
from loomline.storage import written


@dataclass(frozen=True)
class SpeechConfig:
    min_duration: float = 0.5
    max_duration: float = 30.0
    min_words: int = 1
    max_chars_per_sec: float = 25.0
    require_transcript: bool = True


def drop_reason(transcript, duration, config: SpeechConfig = SpeechConfig()):
    """The first rule that fails; null if none does. An unknown duration passes its rules."""
    pace = F.when(duration.isNotNull(), F.length(transcript) / F.greatest(duration, F.lit(0.01)))
    rule = F.when(F.lit(config.require_transcript) & (F.length(X.strip(transcript)) == 0), F.lit("empty_transcript")).when(X.word_count(transcript) < config.min_words, F.lit("too_few_words"))
    return (
        rule.when(duration < config.min_duration, F.concat(F.lit("too_short("), duration.cast("string"), F.lit("s)")))
        .when(duration > config.max_duration, F.concat(F.lit("too_long("), duration.cast("string"), F.lit("s)")))
        .when(pace > config.max_chars_per_sec, F.concat(F.lit("chars_per_sec_high("), F.format_string("%.1f", pace), F.lit(")")))
    )


def curate(samples: DataFrame, config: SpeechConfig = SpeechConfig(), order: str = "ord") -> DataFrame:
    """samples with normalised transcript and drop_reason; among those that pass, the first of equal transcripts (in lower case) stays."""
    tidy = samples.withColumn("transcript", X.normalize(F.col("transcript")))
    judged = tidy.withColumn("_rule", drop_reason(F.col("transcript"), F.col("duration_sec"), config))
    # Normalised and judged once; firsts and their join read narrow columns of the table.
    marked = keep_first(written(judged, "speech"), F.sha2(F.lower("transcript"), 256), order, F.col("_rule").isNull())
    return marked.withColumn("drop_reason", F.coalesce("_rule", F.when(F.col("parent").isNotNull(), F.lit("duplicate_transcript")))).drop("_rule", "parent")


def curation_summary(curated: DataFrame) -> DataFrame:
    """reason, count of dropped samples."""
    return curated.filter(F.col("drop_reason").isNotNull()).groupBy(reason_kind(F.col("drop_reason")).alias("reason")).count()


def stats(samples: DataFrame) -> DataFrame:
    """language, utterances, hours (4 places), speakers; null language is und, null duration 0, empty speakers don't count."""
    return samples.groupBy(F.coalesce("language", F.lit("und")).alias("language")).agg(
        F.count("*").alias("utterances"), F.round(F.coalesce(F.sum("duration_sec"), F.lit(0.0)) / 3600, 4).alias("hours"), F.count_distinct(F.when(F.length("speaker_id") > 0, F.col("speaker_id"))).alias("speakers")
    )


def total_stats(samples: DataFrame) -> DataFrame:
    """One row: num_utterances, total_hours, num_speakers, num_languages."""
    return samples.agg(
        F.count("*").alias("num_utterances"),
        F.round(F.coalesce(F.sum("duration_sec"), F.lit(0.0)) / 3600, 4).alias("total_hours"),
        F.count_distinct(F.when(F.length("speaker_id") > 0, F.col("speaker_id"))).alias("num_speakers"),
        F.count_distinct(F.coalesce("language", F.lit("und"))).alias("num_languages"),
    )
