"""Readers, writers, the whole run, the command line and streaming."""

import gzip
import json
import wave

import pytest
from pyspark.sql import functions as F

from loomline import cli
from loomline.plans.pipeline import Pipeline, filter_dedup_job, run_pipeline
from loomline.sources import readers, sinks
from loomline.streaming.dedup import clean_stream, counts_stream, dedup_stream

EN = "The river rises in the mountains and flows slowly through the wide green valley to the sea."
HI = "".join(map(chr, (0x928, 0x926, 0x940))) + " " + "".join(map(chr, (0x92A, 0x939, 0x93E, 0x921))) + " "
RAW = [
    {"id": "en-1", "text": EN, "parallel_id": "p1"}, {"id": "hi-1", "text": HI * 8, "parallel_id": "p1"}, {"id": "en-2", "text": EN + "  "}, {"id": "near", "text": EN.replace("slowly", "slowlyy")},
    {"id": "noise", "text": "### $$$ %%% &&& !!! ??? ***"}, {"id": "short", "text": "hi"}, {"id": "bench", "text": "Quite another text which holds this very question about seven wonders of the old world and more."},
    {"text": "A document with no id of its own but plenty of words to be kept by every rule.", "language": "fr"}, {"id": "blank", "text": ""},
]


@pytest.fixture()
def raw(tmp_path):
    lines = [json.dumps(r, ensure_ascii=False) for r in RAW]
    (tmp_path / "raw.jsonl").write_text("\n".join([*lines[:2], "", *lines[2:]]), encoding="utf-8")
    (tmp_path / "benchmark.jsonl").write_text(json.dumps({"id": "b1", "text": "this very question about seven wonders of the old world"}), encoding="utf-8")
    return tmp_path


def test_jsonl(spark, raw):
    rows = {r["id"]: r for r in readers.read_file(spark, f"{raw}/raw.jsonl", license="CC0").collect()}
    assert set(rows) == {"en-1", "hi-1", "en-2", "near", "noise", "short", "bench", "raw-8"}  # blank lines count
    r = rows["raw-8"]
    assert (r["language"], r["language_confidence"], r["ord"], r["source"]["license"], r["stages"]) == ("fr", 1.0, 8, "CC0", ["collected"])
    assert rows["en-1"]["metadata"] == {"parallel_id": "p1"} and rows["en-1"]["language"] is None


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("\n".join(f"line {i}" for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = readers.numbered_lines(spark, f"{tmp_path}/big.txt").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == 5000 and all(r["value"] == f"line {r['line']}" for r in got)


def test_text_parquet_html_api_warc(spark, tmp_path):
    (tmp_path / "doc.txt").write_text("first\n\n\n  \n\nsecond\nline\n\n")
    assert [(r["id"], r["text"]) for r in readers.read_file(spark, f"{tmp_path}/doc.txt").orderBy("ord").collect()] == [("doc-0", "first"), ("doc-1", "second\nline")]
    spark.createDataFrame([("a", "x", 1), ("b", "", 2), ("c", None, 3)], "id string, text string, other int").coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    assert [r["id"] for r in readers.read_file(spark, f"{tmp_path}/t.parquet").collect()] == ["a"]
    for name, page in (("b", "<p>two</p>"), ("a", "<p>one</p>"), ("c", "<script>x</script>")):
        (tmp_path / f"{name}.html").write_text(page)
    assert [(r["id"], r["text"], r["source"]["source_id"]) for r in readers.read_source(spark, {"type": "web", "fixtures_dir": str(tmp_path)}).orderBy("ord").collect()] == [("web-fixture-0", "one", "a.html"), ("web-fixture-1", "two", "b.html")]
    api = readers.read_api(spark, [{"data": [{"id": 5, "text": "x", "language": "hi", "n": 1}, {"text": ""}]}, [{"text": "y"}]]).orderBy("ord").collect()
    assert [(r["id"], r["language"], r["metadata"]) for r in api] == [("5", None, {"language": "hi", "n": "1"}), ("api-0", None, {})]
    (tmp_path / "crawl.tsv").write_text("http://a\t<p>A</p>\nno tab\nhttp://b\t<p>B</p>")
    assert [(r["id"], r["text"], r["source"]["license"]) for r in readers.read_source(spark, {"type": "warc", "path": f"{tmp_path}/crawl.tsv"}).orderBy("ord").collect()] == [("cc-0", "A", "Common Crawl ToU"), ("cc-2", "B", "Common Crawl ToU")]
    body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n<p>From WARC/1.0</p>"
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Target-URI: http://w\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(record % (b"request", 3, b"GET") + record % (b"response", len(body), body)))
    assert [(r["id"], r["text"], r["source"]["source_id"]) for r in readers.read_warc(spark, f"{tmp_path}/c.warc.gz").collect()] == [("cc-0", "From WARC/1.0", "http://w")]
    with pytest.raises(ValueError, match="unknown source type"):
        readers.read_source(spark, {"type": "ftp"})
    (tmp_path / "urls.txt").write_text("# note\nhttp://a\n\n http://b ")
    assert readers.url_list(spark, urls_file=f"{tmp_path}/urls.txt") == ["http://a", "http://b"] and readers.url_list(spark) == []


def test_parsed_html_and_crawl(spark):
    page = "<nav>menu</nav><p>Caf&eacute;</p><script>x</script><footer>f</footer>" + "<p>more words</p>" * 6
    df = spark.createDataFrame([("u", page), ("v", "<p>tiny</p>")], "url string, html string")
    assert df.select(readers.parsed_html("html")).first()[0].startswith("Caf\xe9 more words")
    assert [(r["id"], r["language"]) for r in readers.crawl_records(df).collect()] == [("u", "en")]
    assert readers.read_pages(df.withColumn("page_id", F.lit(3))).count() == 2


def test_speech_readers(spark, tmp_path):
    (tmp_path / "cv.tsv").write_text('client_id\tpath\tsentence\tup_votes\tdown_votes\tlocale\nabcdefghijklmnopqrstuvwxyz\ta.mp3\t"Hello ""there"""\t2\tx\ten\ns2\tb.mp3\t\t1\t0\tta\ns3\tc.wav\tThird\t\t\tta\n')
    (tmp_path / "clips").mkdir()
    with wave.open(str(tmp_path / "clips/c.wav"), "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(100)
        f.writeframes(b"\0\0" * 150)
    rows = readers.read_common_voice(spark, f"{tmp_path}/cv.tsv").orderBy("ord").collect()
    assert [(r["id"], r["transcript"], r["language"], r["duration_sec"]) for r in rows] == [("abcdefghijklmnop-0", 'Hello "there"', "en", None), ("s3-2", "Third", "ta", 1.5)]
    assert rows[0]["metadata"] == {"up_votes": "2", "down_votes": "0"}
    (tmp_path / "slr.txt").write_text("sp_1_u1  some words here\n\nlonely\nu2\tmore")
    got = readers.read_openslr(spark, f"{tmp_path}/slr.txt", "/audio").orderBy("ord").collect()
    assert [(r["id"], r["transcript"], r["speaker_id"], r["audio_path"]) for r in got] == [("sp_1_u1", "some words here", "sp_1", "/audio/sp_1_u1.wav"), ("u2", "more", None, "/audio/u2.wav")]


def test_run(spark, raw):
    config = {
        "dataset": {"name": "demo", "version": "1"},
        "collect": {"sources": [{"type": "file", "path": f"{raw}/raw.jsonl", "license": "CC0"}]},
        "align": {"enabled": True},
        "validate": {"contamination": {"enabled": True, "benchmarks_file": f"{raw}/benchmark.jsonl", "ngram": 8}, "near_dedup": {"threshold": 0.8}},
        "export": {"output_dir": f"{raw}/out", "formats": ["jsonl", "parquet"]},
    }
    plan = Pipeline(spark, config)
    manifest = plan.run()
    dropped = {r["id"]: (r["drop_stage"], r["drop_reason"], r["parent"]) for r in plan.audit().collect()}
    assert dropped["en-2"] == ("exact", "exact_duplicate_of:en-1", "en-1") and dropped["near"][:2] == ("near", "near_duplicate_of:en-1")
    assert dropped["bench"] == ("contamination", "contaminated_by:b1", "b1") and dropped["short"][1] == "too_short(<20chars)" and dropped["noise"][0] == "filter"
    assert manifest["num_records"] == 3 and manifest["licenses"] == {"CC0": 3} and manifest["sources"] == {"file": 3}
    assert manifest["stage_stats"] == {"collected": 8, "aligned_pairs": 1, "filtered_out": 2, "exact_duplicates_removed": 1, "near_duplicates_removed": 1, "semantic_duplicates_removed": 0, "contaminated_removed": 1}
    assert manifest["diversity"]["num_languages"] == 3
    rows = {r["id"]: r for r in spark.read.json(f"{raw}/out/dataset.jsonl").collect()}
    assert set(rows) == {"en-1", "hi-1", "raw-8"} and rows["en-1"]["stages"].split(",")[-1] == "exported" and "aligned" in rows["en-1"]["stages"]
    assert rows["hi-1"]["meta_script_ambiguous"] is True and rows["en-1"]["meta_word_count"] == 17 and rows["en-1"]["meta_parallel_id"] == "p1"
    assert spark.read.parquet(f"{raw}/out/dataset.parquet").count() == 3 and spark.read.json(f"{raw}/out/aligned_pairs.jsonl").count() == 1
    assert json.loads((raw / "out/manifest.json").read_text())["content_version"] == manifest["content_version"]
    assert "# demo" in (raw / "out/DATASET_CARD.md").read_text()
    again = run_pipeline(spark, config | {"export": {"output_dir": f"{raw}/other"}, "enrich": {"diversity": False}} | {"enrich": {}})
    assert again["num_records"] == 3
    assert "n/a" in sinks.dataset_card({"dataset_name": "x"})
    with pytest.raises(ValueError, match="no sources"):
        run_pipeline(spark, {})


def test_bulk_job(spark, tmp_path):
    good = "this is a perfectly good sentence"
    spark.createDataFrame([(good,), (good,), ("?? !! ??",), ("another fine sentence to keep",)], "text string").write.parquet(f"{tmp_path}/in")
    assert filter_dedup_job(spark, f"{tmp_path}/in", f"{tmp_path}/out") == {"backend": "spark", "input_rows": 4, "output_rows": 2, "removed": 2, "output_path": f"{tmp_path}/out"}


def test_command_line(spark, raw, capsys):
    def out(*args):
        assert cli.main(list(args)) == 0
        return json.loads(capsys.readouterr().out)

    assert out("dedup", "--input", f"{raw}/raw.jsonl", "--output", f"{raw}/d.jsonl")["removed"]["exact"] == 1 and spark.read.json(f"{raw}/d.jsonl").count() > 0
    assert out("validate", "--input", f"{raw}/raw.jsonl")["documents"] == 8
    assert out("stats", "--input", f"{raw}/raw.jsonl")["num_documents"] == 8
    items = [{"id": "1", "text": "t", "gold_label": True, "annotations": [{"item_id": "1", "annotator_id": a, "label": x} for a, x in (("a", True), ("b", 1), ("c", 0))]}]
    (raw / "ann.jsonl").write_text("\n".join(map(json.dumps, items)))
    assert out("annotate", "--input", f"{raw}/ann.jsonl")["annotator_accuracy"] == {"a": 1.0, "b": 1.0, "c": 0.0}
    (raw / "seeds.jsonl").write_text(json.dumps({"id": "s", "instruction": "Do it", "output": "done"}))
    assert out("synthetic", "--input", f"{raw}/seeds.jsonl", "--output", f"{raw}/syn") == {"seeds": 1, "generated": 3, "clean": 3, "issues": 0}
    (raw / "cv.tsv").write_text("client_id\tpath\tsentence\nc\ta.mp3\tsome words\nc\tb.mp3\tSome words\n")
    assert out("speech", "--input", f"{raw}/cv.tsv", "--output", f"{raw}/manifest")["curation"] == {"input": 2, "kept": 1, "dropped_reasons": {"duplicate_transcript": 1}}
    spark.createDataFrame([(EN, "en"), (EN, None)], "text string, language string").coalesce(1).write.parquet(f"{raw}/p.parquet")
    assert out("stats", "--input", f"{raw}/p.parquet") == {"num_documents": 2, "languages": {"en": 1}}
    assert out("scale", "--input", f"{raw}/p.parquet", "--output", f"{raw}/s")["output_rows"] == 1
    (raw / "c.json").write_text(json.dumps({"collect": {"sources": [{"path": f"{raw}/raw.jsonl"}]}, "export": {"output_dir": f"{raw}/cli"}}))
    assert out("run", "--config", f"{raw}/c.json")["num_records"] >= 3


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", EN, "2024-01-01 00:00:00"), (2, "a", "?!", "2024-01-01 00:01:00"), (3, "b", EN, "2024-01-01 02:00:00")], "i long, k string, text string, t string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(f"{tmp_path}/in")

    def run(stream, mode="append"):
        out, state = f"{tmp_path}/{id(stream)}", f"{tmp_path}/state{id(stream)}"
        q = stream.writeStream.format("memory").queryName(f"q{abs(id(stream))}").outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(f"q{abs(id(stream))}").collect(), out

    source = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    assert sorted(r["k"] for r in run(dedup_stream(source(), ["k"], "t", "1 day"))[0]) == ["a", "b"]
    assert sorted(r["i"] for r in run(clean_stream(source()))[0]) == [1, 3]
    assert {(r["k"], r["count"]) for r in run(counts_stream(source(), "k", "t"), "complete")[0]} == {("a", 2), ("b", 1)}
