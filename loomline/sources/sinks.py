"""Writers. Tables are written by the executors as folders of part files; a single file only on demand."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.stats import funnel

EXPORTED = "exported"


def export_rows(docs: DataFrame) -> DataFrame:
    """The columns of an export: source fields flat, confidence to 4 places, stages joined, metadata as meta_ columns.

    Metadata keys are those that occur; they are found by one distinct count over the map's keys.
    """
    keys = sorted(r["k"] for r in docs.select(F.explode(F.map_keys("metadata")).alias("k")).distinct().collect())
    stages = F.when(F.array_contains("stages", EXPORTED), F.col("stages")).otherwise(F.array_append("stages", F.lit(EXPORTED)))
    extra = [c for c in ("quality_score", "char_count", "word_count", "line_count", "unique_word_ratio", "avg_word_length", "script_ambiguous") if c in docs.columns]
    return docs.select(
        "id", "text", "language", F.round("language_confidence", 4).alias("language_confidence"), "source.source_type", "source.source_id",
        F.date_format("source.collected_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("collected_at"), "source.license", "hash", F.array_join(stages, ",").alias("stages"),
        *[F.col("metadata")[k].alias(f"meta_{k}") for k in keys], *[F.col(c).alias(f"meta_{c}") for c in extra if c not in keys],
    )


def write_jsonl(df: DataFrame, path: str, single: bool = False) -> None:
    """JSON lines; null fields stay."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_dataset(df: DataFrame, path: str) -> None:
    """A dataset folder that common loaders read: Parquet parts."""
    write_parquet(df, f"{path}/data")


def write_speech_manifest(samples: DataFrame, path: str, single: bool = False) -> None:
    write_jsonl(samples.select(F.col("audio_path").alias("audio_filepath"), F.col("transcript").alias("text"), F.col("duration_sec").alias("duration"), "language", "speaker_id"), path, single)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text through Spark's file systems."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    write_text(spark, json.dumps(manifest, ensure_ascii=False, indent=2, default=str), path)


#: The keys of a card's front matter, with where a manifest has them.
FRONT_MATTER = ("dataset_name", "version", "language", "license")


def dataset_card(manifest: dict) -> str:
    """A dataset card in Markdown from a run's manifest; what a run didn't measure is n/a."""
    diversity = manifest.get("diversity") or {}
    languages, licenses = diversity.get("language_distribution") or {}, manifest.get("licenses") or {}
    front = dict(zip(FRONT_MATTER, (manifest.get("dataset_name"), manifest.get("content_version"), list(languages), list(licenses)), strict=True))
    number = lambda x: f"{x:,}" if isinstance(x, int) else "n/a"
    facts = {
        "Content version": f"`{manifest.get('content_version')}`",
        "Generated at": manifest.get("generated_at"),
        "Records": number(manifest.get("num_records")),
        "Languages": diversity.get("num_languages", "n/a"),
        "Tokens": number(diversity.get("total_tokens")),
        "Vocabulary": number(diversity.get("vocabulary_size")),
        "Language balance": diversity.get("language_balance", "n/a"),
    }
    removed = {k: v for k, v in (manifest.get("stage_stats") or {}).items() if k not in ("collected", "aligned_pairs")}
    lines = ["---", *(f"{k}: {v}" for k, v in front.items()), "---", "", f"# {front['dataset_name']}", "", "Generated from the manifest of the run that made this dataset.", ""]
    lines += [f"* {k}: {v}" for k, v in facts.items()]
    for title, column, counts in (("Languages", "language", languages), ("Sources", "source type", manifest.get("sources") or {}), ("Licenses", "license", licenses), ("Removed, by stage", "stage", removed)):
        lines += ["", f"## {title}"]
        if counts:
            lines += [f"| {column} | documents |", "|---|---|"]
            lines += [f"| {value} | {count} |" for value, count in counts.items()]
        else:
            lines.append("Nothing counted.")
    lines += ["", "## Limits", "* Languages are told by script; one language stands for all that share a script.", "* Contamination was looked for in the given benchmarks only.", ""]
    return "\n".join(lines)


def run_report(manifest: dict) -> str:
    """A page about a run: its numbers, the funnel of its stages, languages, sources and licenses as bars."""
    from html import escape

    numbers, diversity = manifest.get("stage_stats") or {}, manifest.get("diversity") or {}
    name = escape(str(manifest.get("dataset_name")))

    def bars(title: str, rows: list[tuple[str, int]]) -> str:
        most = max((n for _, n in rows), default=0) or 1
        line = lambda label, n: f"<tr><th>{escape(str(label))}</th><td><div style='background:#468;height:1em;width:{30 * n / most:.2f}em'></div></td><td>{n:,}</td></tr>"
        return f"<h2>{title}</h2><table>{''.join(line(*r) for r in rows)}</table>" if rows else ""

    parts = [
        bars("Stages", funnel(numbers, manifest.get("num_records") or 0)),
        bars("Removed", [(k, n) for k, n in numbers.items() if k not in ("collected", "aligned_pairs")]),
        bars("Languages", list((diversity.get("language_distribution") or {}).items())),
        bars("Sources", list((manifest.get("sources") or {}).items())),
        bars("Licenses", list((manifest.get("licenses") or {}).items())),
    ]
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{name}</title></head><body><h1>{name}</h1><p>Version {escape(str(manifest.get('content_version')))}</p>{''.join(parts)}</body></html>"
