"""Readers. Each gives documents in one schema: id, text, language, language_confidence, source, metadata, stages, ord.

``ord`` is the row's place in its source, counted as the source's own ids are; it is the order of every keep-first
operator. Files are read by Spark, so any path that Spark opens will do; only live web and API reads need a network:
executors fetch, and a caller may give the function that does.
"""

from __future__ import annotations

import json
import wave
from collections.abc import Callable, Iterator

import pandas as pd
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions import text as X

SOURCE = "struct<source_type:string,source_id:string,collected_at:timestamp,collector:string,license:string>"
COLLECTED = "collected"


def documents(rows: DataFrame, kind: str, source_id: Column, license: str | None = None, collector: str = "loomline", language: Column | None = None, metadata: Column | None = None) -> DataFrame:
    """Rows with id, text and ord in the canonical schema. A language that the source gives is certain."""
    told = F.lit(None).cast("string") if language is None else F.when(F.length(language) > 0, language)
    return rows.select(
        F.col("id").cast("string").alias("id"),
        "text",
        told.alias("language"),
        F.when(told.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)).alias("language_confidence"),
        F.struct(F.lit(kind).alias("source_type"), source_id.cast("string").alias("source_id"), F.current_timestamp().alias("collected_at"), F.lit(collector).alias("collector"), F.lit(license).cast("string").alias("license")).alias("source"),
        (F.create_map().cast("map<string,string>") if metadata is None else metadata).alias("metadata"),
        F.array(F.lit(COLLECTED)).alias("stages"),
        F.col("ord").cast("long").alias("ord"),
    )


def in_places(rows: DataFrame) -> DataFrame:
    """rows with file, line (the row's place in its file, from 0) and place (that over all files, in the order of their names).

    Rows are filters and columns of one scan; those that it leaves out aren't counted. A place is the sum of the rows of
    the splits before it and the place in its own split, so no file has to be read by one task. Splits, a row each, are broadcast.
    """
    at = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    sizes = at.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_start", F.min("_base").over(Window.partitionBy("file"))).drop("_n")
    place = F.col("_at") - F.col("_first") + F.col("_base")
    return at.join(F.broadcast(bases), ["file", "_block"]).select(*rows.columns, "file", (place - F.col("_start")).alias("line"), place.alias("place"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line (from 0, blank lines counted), file of text files, and each line's place over all files, in the order of their names."""
    return in_places(spark.read.text(path).select("value", "_metadata"))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files have fewer splits than there are cores: a shuffle of a small input only."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def stem(path: str | Column) -> Column:
    """A file's name without its ending."""
    path = F.lit(path) if isinstance(path, str) else path
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def read_jsonl(spark: SparkSession, path: str, text_field: str = "text", id_field: str = "id", license: str | None = None) -> DataFrame:
    """A document per line with text. Ids default to file and line number; other keys become metadata; `language` is taken over."""
    lines = numbered_lines(spark, path).filter(F.length(X.strip(F.col("value"))) > 0)
    parsed = lines.withColumn("m", F.from_json("value", "map<string,string>"))
    rows = parsed.select(F.coalesce(F.col("m")[id_field], F.concat_ws("-", stem(F.col("file")), "line")).alias("id"), F.col("m")[text_field].alias("text"), "m", F.col("place").alias("ord"), "file").filter(F.length("text") > 0)
    rest = F.map_filter("m", lambda k, v: ~k.isin(text_field, id_field, "language"))
    return documents(rows, "file", F.col("file"), license, language=F.col("m")["language"], metadata=rest)


def place_in_files(found: DataFrame) -> Column:
    """A row's place in Parquet files, in the order of their names: the file's number times 2^40 plus the row's place in it.

    Reads no column to list the files; the list, a row per file, is a map in the plan.
    """
    files = sorted(r["f"] for r in found.select(F.col("_metadata.file_path").alias("f")).distinct().collect())
    at = F.col("_metadata.row_index")
    if len(files) > 1:
        at = at + F.element_at(F.map_from_arrays(F.lit(files), F.lit([i << 40 for i in range(len(files))])), F.col("_metadata.file_path"))
    return at


def read_parquet(spark: SparkSession, path: str, text_field: str = "text", id_field: str = "id", license: str | None = None, order: str | None = None, dense: bool = False) -> DataFrame:
    """Only text and id are read. Without an id column ids are the file's name and the row's place in it.

    ord is a column, or the place of place_in_files(); dense: the place among all rows with text, over all files.
    """
    found = spark.read.parquet(path)
    given = F.col(id_field).cast("string") if id_field in found.columns else F.lit(None).cast("string")
    text = F.col(text_field)
    if isinstance(found.schema[text_field].dataType, (T.FloatType, T.DoubleType)):
        text = F.when(~F.isnan(text), text)
    place = F.lit(None).cast("long") if dense else F.col(order).cast("long") if order else place_in_files(found)
    rows = found.select(given.alias("given"), text.cast("string").alias("text"), place.alias("ord"), F.col("_metadata.row_index").alias("row"), "_metadata").filter(F.length("text") > 0)
    rows = in_places(rows).withColumn("ord", F.col("place")) if dense else rows.withColumn("file", F.col("_metadata.file_path"))
    return documents(rows.withColumn("id", F.coalesce("given", F.concat_ws("-", stem(F.col("file")), "row"))), "file", F.col("file"), license)


def read_text(spark: SparkSession, path: str, license: str | None = None) -> DataFrame:
    """A document per paragraph (parted by empty lines); blank ones don't count."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    parts = F.filter(F.transform(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n\n"), X.strip), lambda x: F.length(x) > 0)
    rows = whole.select("file", F.posexplode(parts).alias("ord", "text")).withColumn("id", F.concat_ws("-", stem(F.col("file")), "ord"))
    return documents(rows, "file", F.col("file"), license)


def read_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """By the path's ending: .jsonl, .parquet, else text."""
    if path.endswith(".jsonl"):
        return read_jsonl(spark, path, **options)
    if path.endswith(".parquet"):
        return read_parquet(spark, path, **options)
    return read_text(spark, path, license=options.get("license"))


def read_html_folder(spark: SparkSession, folder: str, license: str | None = None, extract: Callable[[Column], Column] = X.html_text) -> DataFrame:
    """A document per *.html file in the order of names; pages without text are left out but counted."""
    pages = spark.read.option("pathGlobFilter", "*.html").text(folder, wholetext=True).select(extract(F.col("value")).alias("text"), F.col("_metadata.file_name").alias("name"))
    names = pages.select("name").distinct().withColumn("ord", F.row_number().over(Window.orderBy("name")) - 1)  # file names only
    rows = pages.join(names, "name").filter(F.length("text") > 0).withColumn("id", F.concat(F.lit("web-fixture-"), "ord"))
    return documents(rows, "web", F.col("name"), license, metadata=F.create_map(F.lit("retrieved"), F.lit("fixture")))


@F.pandas_udf(T.StringType())
def parsed_html(pages: pd.Series) -> pd.Series:
    """Text without scripts, styles, navigation, headers and footers, references decoded, by the standard library's parser."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        skipped = ("script", "style", "nav", "footer", "header")

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts, self.deep = [], 0

        def handle_starttag(self, tag, attrs):
            self.deep += tag in self.skipped

        def handle_endtag(self, tag):
            self.deep -= tag in self.skipped and self.deep > 0

        def handle_data(self, data):
            if not self.deep:
                self.parts.append(data)

    def text(page):
        reader = Reader()
        reader.feed(page or "")
        reader.close()
        return " ".join(" ".join(reader.parts).split())

    return pages.map(text)


def url_list(spark: SparkSession, urls: list[str] | None = None, urls_file: str | None = None) -> list[str]:
    """The configured addresses, or a file's lines but for blank ones and those that start with #. A configuration-sized list."""
    if urls:
        return list(urls)
    if not urls_file:
        return []
    line = X.strip(F.col("value"))
    return [r["u"] for r in spark.read.text(urls_file).select(line.alias("u")).filter((F.length("u") > 0) & ~F.col("u").startswith("#")).collect()]


def read_pages(pages: DataFrame, url: str = "url", html: str = "html", order: str = "page_id", license: str | None = None, extract: Callable[[Column], Column] = X.html_text) -> DataFrame:
    """Documents from a table of fetched pages."""
    rows = pages.select(F.concat(F.lit("web-"), F.col(order).cast("string")).alias("id"), extract(F.coalesce(F.col(html), F.lit(""))).alias("text"), F.col(order).alias("ord"), F.col(url).alias("_url")).filter(F.length("text") > 0)
    return documents(rows, "web", F.col("_url"), license)


def _get(url: str, headers: dict[str, str]) -> tuple[int, str]:
    """(status, text) of an address; an error status raises."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers=headers), timeout=30) as answer:
        return answer.status, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")


def fetch_pages(spark: SparkSession, urls: list[str] | DataFrame, delay: float = 1.0, agent: str = "loomline (+research)", get: Callable[[str, dict], tuple[int, str]] = _get) -> DataFrame:
    """page_id, url, html, status of live pages. The pages of a host are fetched by one task, `delay` seconds apart.

    Written by the caller before it is used twice: a plan over it fetches anew each time.
    """
    if not isinstance(urls, DataFrame):
        urls = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for batch in batches:
            for k, (page, url) in enumerate(zip(batch["page_id"], batch["url"], strict=True)):
                if k and delay:
                    time.sleep(delay)
                status, html = get(url, {"User-Agent": agent})
                yield pd.DataFrame({"page_id": [page], "url": [url], "html": [html], "status": [status]})

    host = F.expr("parse_url(url, 'HOST')")
    return urls.select("page_id", "url").repartition(host).sortWithinPartitions(host, "page_id").mapInPandas(fetched, "page_id long, url string, html string, status int")


def fetch_api(spark: SparkSession, endpoint: str, max_pages: int = 1, records_path: str = "data", headers: dict[str, str] | None = None, get: Callable[[str, dict], tuple[int, str]] = _get) -> DataFrame:
    """ord, page, i, record (JSON text) of a paged API: ?page=0, 1, ... up to max_pages or the first empty page.

    An API's pages come one after the other, so one task asks for them; its records stream out page by page.
    """

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            n = 0
            for page in range(max_pages):
                payload = json.loads(get(f"{endpoint}{'&' if '?' in endpoint else '?'}page={page}", headers or {})[1])
                records = payload.get(records_path, payload) if isinstance(payload, dict) else payload
                if not records:
                    break
                yield pd.DataFrame({"ord": range(n, n + len(records)), "page": page, "i": range(len(records)), "record": [json.dumps(r, ensure_ascii=False) for r in records]})
                n += len(records)

    return spark.range(1).mapInPandas(fetched, "ord long, page int, i long, record string")


def read_records(records: DataFrame, endpoint: str, text_field: str = "text", id_field: str = "id", license: str | None = None) -> DataFrame:
    """Documents from API records in JSON (columns ord, i, record); ids default to the place in the page, other keys are metadata."""
    parsed = records.withColumn("m", F.from_json("record", "map<string,string>"))
    rows = parsed.select(F.coalesce(F.col("m")[id_field], F.concat(F.lit("api-"), "i")).alias("id"), F.col("m")[text_field].alias("text"), "ord", F.map_filter("m", lambda k, v: ~k.isin(text_field, id_field)).alias("rest")).filter(F.length("text") > 0)
    return documents(rows, "api", F.lit(endpoint), license, metadata=F.col("rest"))


def read_api(spark: SparkSession, payloads: list[dict | list], endpoint: str = "fixture", text_field: str = "text", id_field: str = "id", records_path: str = "data", license: str | None = None) -> DataFrame:
    """Documents from the pages of an API: lists of records, or mappings that hold one; `language` stays metadata."""
    lines, at = [], 0
    for page in payloads:
        for i, record in enumerate(page if isinstance(page, list) else page.get(records_path, [])):
            text = record.get(text_field)
            if text:
                rest = {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in record.items() if k not in (text_field, id_field)}
                lines.append((str(record.get(id_field) or f"api-{i}"), text, at, rest))
            at += 1
    rows = spark.createDataFrame(lines, "id string, text string, ord long, rest map<string,string>")
    return documents(rows, "api", F.lit(endpoint), license, metadata=F.col("rest"))


def read_warc_lines(spark: SparkSession, path: str, license: str = "Common Crawl ToU", extract: Callable[[Column], Column] = X.html_text) -> DataFrame:
    """A document per line of address, tab, html; other lines are left out but counted, from file to file in the order of names."""
    lines = numbered_lines(spark, path).filter(F.contains("value", F.lit("\t")))
    part = F.split("value", "\t", 2)
    rows = lines.select(F.concat(F.lit("cc-"), "place").alias("id"), extract(part[1]).alias("text"), F.col("place").alias("ord"), part[0].alias("uri")).filter(F.length("text") > 0)
    return documents(rows, "warc", F.col("uri"), license)


def read_warc(spark: SparkSession, path: str, license: str = "Common Crawl ToU", extract: Callable[[Column], Column] = X.html_text) -> DataFrame:
    """A document per response record of WARC files (plain or gzip); a file is one task, its records stream out.

    A task holds the file as it is stored and one record at a time; gzip members are unpacked while they are read.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import io

        def record(stream) -> tuple[dict, bytes] | None:
            line = stream.readline()
            while line and not line.startswith(b"WARC/"):
                line = stream.readline()
            if not line:
                return None
            head = {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                head[name.strip().lower()] = value.strip()
            return head, stream.read(int(head.get("content-length") or 0))

        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                stream = io.BytesIO(content)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if content[:2] == b"\x1f\x8b" else stream
                number, rows, size = 0, [], 0
                while found := record(stream):
                    head, body = found
                    if head.get("warc-type") == "response":
                        rows.append((file, number, head.get("warc-target-uri", ""), body.partition(b"\r\n\r\n")[2].decode("utf-8", "replace")))
                        number, size = number + 1, size + len(body)
                    if size > 8 << 20 or len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=["file", "ord", "uri", "html"])
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["file", "ord", "uri", "html"])

    found = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(records, "file string, ord long, uri string, html string")
    rows = found.select(F.concat(F.lit("cc-"), "ord").alias("id"), extract(F.col("html")).alias("text"), "ord", "uri").filter(F.length("text") > 0)
    return documents(rows, "warc", F.col("uri"), license)


def crawl_records(pages: DataFrame, url: str = "url", html: str = "html", min_chars: int = 50) -> DataFrame:
    """id, text, language, language_confidence, source_url of fetched pages with enough text: the record of a crawler."""
    from loomline.functions.language import detect

    rows = pages.select(F.col(url).alias("id"), X.html_text(F.coalesce(F.col(html), F.lit(""))).alias("text")).filter(F.length("text") >= min_chars)
    return rows.withColumn("_told", detect(F.col("text"))).select("id", "text", "_told.language", F.col("_told.confidence").alias("language_confidence"), F.col("id").alias("source_url"))


AUDIO = "id string, audio_path string, transcript string, language string, duration_sec double, sample_rate int, speaker_id string, split string, source string, metadata map<string,string>, ord long"


@F.pandas_udf(T.DoubleType())
def wav_duration(paths: pd.Series) -> pd.Series:
    """Seconds (3 places) of .wav files that can be opened; else null."""

    def seconds(path):
        try:
            with wave.open(path) as f:
                return round(f.getnframes() / f.getframerate(), 3)
        except Exception:  # no such file, or no wave
            return None

    return paths.map(seconds).astype("float64")


def _seconds(content: bytes) -> float | None:
    """Seconds (3 places) of the bytes of a .wav or .flac file; else None."""
    import io

    try:
        if content[:4] == b"fLaC":  # the stream's information begins 8 bytes in: 20 bits of rate, then 8, then 36 of samples
            rate, samples = int.from_bytes(content[18:21], "big") >> 4, int.from_bytes(content[21:26], "big") & ((1 << 36) - 1)
            return round(samples / rate, 3) if rate and samples else None
        with wave.open(io.BytesIO(content)) as f:
            return round(f.getnframes() / f.getframerate(), 3)
    except Exception:  # no wave
        return None


def audio_durations(spark: SparkSession, folder: str, pattern: str = "*.{wav,flac}") -> DataFrame:
    """file_name, duration_sec of the audio files of a folder, by any path that Spark opens; a file is read by one task."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"file_name": batch["file_name"], "duration_sec": pd.Series([_seconds(x) for x in batch["content"]], dtype="float64")})

    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return found.select(F.col("_metadata.file_name").alias("file_name"), "content").mapInPandas(read, "file_name string, duration_sec double")


def with_durations(samples: DataFrame, durations: DataFrame) -> DataFrame:
    """samples with the durations of their files, by file name, where they have none."""
    named = durations.groupBy(F.col("file_name").alias("_file")).agg(F.max("duration_sec").alias("_seconds"))
    met = samples.join(named, F.element_at(F.split("audio_path", "/"), -1) == F.col("_file"), "left")
    return met.withColumn("duration_sec", F.coalesce("duration_sec", "_seconds")).drop("_file", "_seconds")


def read_common_voice(spark: SparkSession, path: str, language: str | None = None, clips_dir: str | None = None, durations: Callable[[Column], Column] = wav_duration) -> DataFrame:
    """Audio samples of a Common Voice table; rows without a sentence are left out but counted."""
    lines = numbered_lines(spark, path)
    names = [c.strip() for c in lines.filter("place = 0").first()["value"].split("\t")]
    clips = clips_dir or f"{path.rpartition('/')[0] or '.'}/clips"
    row = F.from_csv("value", F.lit(", ".join(f"`{c}` string" for c in names)), {"sep": "\t", "quote": '"', "escape": '"'})
    rows = lines.filter("place > 0 and length(value) > 0").select((F.col("place") - 1).alias("ord"), row.alias("r")).select("ord", "r.*")
    get = lambda c: F.col(c) if c in names else F.lit(None).cast("string")
    sentence = X.strip(F.coalesce(get("sentence"), F.lit("")))
    votes = lambda c: F.coalesce(F.expr(f"try_cast(`{c}` as int)") if c in names else F.lit(0), F.lit(0)).cast("string")
    audio = F.concat(F.lit(clips + "/"), F.coalesce(get("path"), F.concat(F.lit("cv-"), "ord", F.lit(".mp3"))))
    return rows.filter(F.length(sentence) > 0).select(
        F.concat(F.substring(F.coalesce(get("client_id"), F.concat(F.lit("cv-"), "ord")), 1, 16), F.lit("-"), "ord").alias("id"),
        audio.alias("audio_path"),
        sentence.alias("transcript"),
        F.coalesce(get("locale"), F.lit(language).cast("string")).alias("language"),
        durations(audio).alias("duration_sec"),
        F.lit(None).cast("int").alias("sample_rate"),
        get("client_id").alias("speaker_id"),
        F.lit(None).cast("string").alias("split"),
        F.lit("common_voice").alias("source"),
        F.create_map(F.lit("up_votes"), votes("up_votes"), F.lit("down_votes"), votes("down_votes")).alias("metadata"),
        "ord",
    )


def read_openslr(spark: SparkSession, path: str, audio_dir: str, language: str | None = None, ext: str = ".wav", durations: Callable[[Column], Column] = wav_duration) -> DataFrame:
    """Audio samples of a transcript file: utterance id, white space, transcript."""
    pattern = rf"(?s)\A({X.NOT_WS}+){X.WS}+(.+)\z"
    line = X.strip(F.col("value"))
    rows = numbered_lines(spark, path).select(F.regexp_extract(line, pattern, 1).alias("id"), F.regexp_extract(line, pattern, 2).alias("transcript"), F.col("place").alias("ord")).filter(F.length("id") > 0)
    audio = F.concat(F.lit(f"{audio_dir}/"), "id", F.lit(ext))
    speaker = F.regexp_extract("id", r"(?s)\A(.*)_[^_]*\z", 1)
    return rows.select(
        "id", audio.alias("audio_path"), "transcript", F.lit(language).cast("string").alias("language"), durations(audio).alias("duration_sec"), F.lit(None).cast("int").alias("sample_rate"),
        F.when(F.contains("id", F.lit("_")), speaker).alias("speaker_id"), F.lit(None).cast("string").alias("split"), F.lit("openslr").alias("source"), F.create_map().cast("map<string,string>").alias("metadata"), "ord",
    )


ITEMS = "id string, text string, task string, gold_label string, annotations array<struct<item_id:string,annotator_id:string,label:string,confidence:double>>"


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation items. Labels of any JSON type become text, true and 1.0 like 1."""
    raw = spark.read.schema(ITEMS).json(path)
    same = lambda c: F.when(c.isin("true", "1.0"), F.lit("1")).when(c.isin("false", "0.0"), F.lit("0")).otherwise(c)
    unified = F.transform("annotations", lambda a: F.struct(a["item_id"].alias("item_id"), a["annotator_id"].alias("annotator_id"), same(a["label"]).alias("label"), F.coalesce(a["confidence"], F.lit(1.0)).alias("confidence")))
    return raw.withColumn("annotations", F.coalesce(unified, F.expr("array()").cast("array<struct<item_id:string,annotator_id:string,label:string,confidence:double>>"))).withColumn("gold_label", same(F.col("gold_label"))).withColumn("task", F.coalesce("task", F.lit("classification")))


SEEDS = "id string, instruction string, input string, output string, language string, task_type string, origin string"


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Instruction examples with their defaults and their line as order."""
    lines = numbered_lines(spark, path).filter(F.length(X.strip(F.col("value"))) > 0).select(F.from_json("value", SEEDS).alias("s"), F.col("place").alias("ord")).select("s.*", "ord")
    return lines.withColumns({"input": F.coalesce("input", F.lit("")), "task_type": F.coalesce("task_type", F.lit("open_qa")), "origin": F.coalesce("origin", F.lit("synthetic"))})


def read_source(spark: SparkSession, config: dict) -> DataFrame:
    """By config["type"]: file, web, api or warc."""
    options = {k: v for k, v in config.items() if k not in ("type", "path")}
    kind = config.get("type", "file")
    if kind == "file":
        return read_file(spark, config["path"], **{k: options[k] for k in ("text_field", "id_field", "license") if k in options})
    if kind == "web":
        if "fixtures_dir" in config:
            return read_html_folder(spark, config["fixtures_dir"], config.get("license"))
        if "pages" in config:
            return read_pages(spark.read.parquet(config["pages"]), license=config.get("license"))
        if urls := url_list(spark, config.get("urls"), config.get("urls_file")):
            return read_pages(fetch_pages(spark, urls, float(config.get("delay", 1.0)), **{k: config[k] for k in ("agent", "get") if k in config}), license=config.get("license"))
        raise ValueError("a web source needs `urls`, `urls_file`, `pages` or `fixtures_dir`")
    if kind == "api":
        if "fixture" in config:
            fixture = config["fixture"]
            payload = [fixture] if isinstance(fixture, (list, dict)) else [json.loads("\n".join(r["value"] for r in spark.read.text(fixture).collect()))]
            return read_api(spark, payload, **{k: options[k] for k in ("endpoint", "text_field", "id_field", "records_path", "license") if k in options})
        if endpoint := config.get("endpoint"):
            records = fetch_api(spark, endpoint, int(config.get("max_pages", 1)), **{k: config[k] for k in ("records_path", "headers", "get") if k in config})
            return read_records(records, endpoint, **{k: options[k] for k in ("text_field", "id_field", "license") if k in options})
        raise ValueError("an API source needs `endpoint` or `fixture`")
    if kind == "warc":
        reader = read_warc if config["path"].endswith((".warc", ".warc.gz")) and config.get("records") else read_warc_lines
        return reader(spark, config["path"], config.get("license", "Common Crawl ToU"))
    raise ValueError(f"unknown source type: {kind}")
