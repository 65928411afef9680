"""What talks to the world: live pages, APIs, search servers, embedders; with stand-ins for the other side."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline import storage
from loomline.functions import vectors
from loomline.operators import dedup, rules, search, stats
from loomline.plans.pipeline import Pipeline
from loomline.sources import readers


def test_live_pages(spark):
    def page(url, headers):  # within the test: workers can't import this module
        assert headers["User-Agent"]
        return (200, f"<p>Page of {url}") if "empty" not in url else (200, "")

    urls = ["http://a.example/1", "http://a.example/empty", "http://b.example/2"]
    found = readers.read_source(spark, {"type": "web", "urls": urls, "delay": 0, "get": page}).orderBy("id").collect()
    assert [(r["id"], r["text"], r["source"]["source_id"]) for r in found] == [("web-0", "Page of http://a.example/1", urls[0]), ("web-2", "Page of http://b.example/2", urls[2])]
    with pytest.raises(ValueError):
        readers.read_source(spark, {"type": "web"})


def test_paged_api(spark):
    def answer(url, headers):
        page = int(url.rpartition("=")[2])
        return 200, json.dumps({"data": [{"id": f"{page}-{i}", "text": f"text {page} {i}", "more": i} for i in range(3)] if page < 2 else []})

    config = {"type": "api", "endpoint": "http://api.example/x", "max_pages": 9, "get": answer}
    found = readers.read_source(spark, config).orderBy("ord").collect()
    assert [r["id"] for r in found] == [f"{p}-{i}" for p in range(2) for i in range(3)] and found[4]["metadata"] == {"more": "1"} and [r["ord"] for r in found] == list(range(6))
    assert readers.fetch_api(spark, "http://api.example/x?q=1", 1, get=answer).count() == 3


@pytest.mark.parametrize("packed", [False, True])
def test_warc_records(spark, tmp_path, packed):
    def record(kind, uri, body):
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    parts = [record("warcinfo", "", b"x"), *[record("response", f"http://x/{i}", f"<p>WARC/ text {i}\r\n\r\nmore</p>".encode()) for i in range(1200)], record("request", "http://x/0", b"y"), record("response", "http://x/e", b"")]
    path = tmp_path / ("a.warc.gz" if packed else "a.warc")
    path.write_bytes(b"".join(map(gzip.compress, parts)) if packed else b"".join(parts))
    found = readers.read_source(spark, {"type": "warc", "path": str(path), "records": True}).orderBy("ord").collect()
    assert len(found) == 1200 and found[7]["id"] == "cc-7" and found[7]["text"] == "WARC/ text 7 more" and found[7]["source"]["source_id"] == "http://x/7"


def test_parquet_places_and_texts(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(f"{k} {i}" if i else "nan",) for i in range(50)], "text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    read = lambda: sorted((r["ord"], r["id"], r["text"]) for r in readers.read_parquet(spark, str(tmp_path / "t.parquet")).collect())
    found = read()
    assert len(found) == 150 == len({i for _, i, _ in found}) and sum(t == "nan" for *_, t in found) == 3 and found == read()
    assert sorted({o >> 40 for o, *_ in found}) == [0, 1, 2] and {o & 63 for o, *_ in found} == set(range(50))
    spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "text double").write.parquet(str(tmp_path / "n.parquet"))
    assert [r["text"] for r in readers.read_parquet(spark, str(tmp_path / "n.parquet")).collect()] == ["1.5"]


def stand_in():
    class Server:
        """A stand-in that keeps its documents in a folder."""

        def __init__(self, folder):
            self.folder, self.indices = folder, self

        def exists(self, index):
            return os.path.isdir(f"{self.folder}/{index}")

        def create(self, index):
            os.makedirs(f"{self.folder}/{index}")

        def index(self, index, id, document):
            with open(f"{self.folder}/{index}/{id}", "w") as f:
                json.dump(document, f)

        def _all(self, index):
            return {i: json.load(open(f"{self.folder}/{index}/{i}")) for i in sorted(os.listdir(f"{self.folder}/{index}"))}

        def count(self, index):
            return {"count": len(self._all(index))}

        def search(self, index, query, size):
            (kind, what), = query.items()
            match = (lambda t: any(w in t for w in what["text"].split())) if kind == "match" else (lambda t: what["text"] in t)
            return {"hits": {"hits": [{"_id": i, "_score": 1.0, "_source": d} for i, d in self._all(index).items() if match(d["text"])][:size]}}

    return Server


def test_search_server(spark, tmp_path):
    folder, kind = str(tmp_path), stand_in()
    server = search.ServerIndex(spark, connect=lambda hosts: kind(folder))
    docs = spark.createDataFrame([(1, "alpha beta", "x"), (2, "beta gamma", "y"), (3, "delta", "z")], "doc_id long, text string, source string")
    index = search.open_index(docs, server=server)
    assert index.size() == 3 and [r["doc_id"] for r in index.search("beta", 10).collect()] == ["1", "2"] and [r["doc_id"] for r in index.exact("delta").collect()] == ["3"]
    assert search.open_index(docs, server=server).size() == 3  # the same ids again
    tables = search.open_index(docs)
    assert tables.size() == 3 and [r["doc_id"] for r in tables.search("beta", 1).collect()] == [1]


def test_embedders(spark, tmp_path):
    docs = spark.createDataFrame([("a", "one two", 0), ("b", "one two!", 1), ("c", "quite another", 2)], "id string, text string, ord long")
    load = lambda name: lambda texts: np.array([[1.0, 0.0] if "one" in t else [0.0, 1.0] for t in texts])
    plan = Pipeline(spark, {})
    told = {r["ord"]: list(r["embedding"]) for r in plan.vectors(docs, {"embedder": "transformer", "load": load}).collect()}
    assert told == {0: [1.0, 0.0], 1: [1.0, 0.0], 2: [0.0, 1.0]}
    path = str(tmp_path / "vectors")
    spark.createDataFrame([("a", [1.0, 0.0]), ("c", [0.6, 0.8])], "id string, embedding array<float>").write.parquet(path)
    assert {r["ord"] for r in plan.vectors(docs, {"vectors": path}).collect()} == {0, 2}
    assert all(len(r["embedding"]) == 256 for r in plan.vectors(docs, {"embedder": "auto"}).collect())
    with pytest.raises(ValueError):
        vectors.embedder({"embedder": "other"})


@pytest.mark.parametrize(("threshold", "num_perm"), [(0.8, 128), (0.6, 128), (0.5, 64), (0.9, 16), (0.8, 64), (0.4, 256)])
def test_banding(threshold, num_perm):
    bands, rows = dedup.banding(threshold, num_perm)
    assert bands * rows <= num_perm and 1 - (1 - threshold**rows) ** bands >= dedup.RECALL
    assert dedup.banding(0.8, 128) == (21, 6)


def test_near_with_other_thresholds(spark):
    rng = np.random.default_rng(4)
    texts = {}
    for g in range(8):
        base = "".join(chr(97 + x) for x in rng.integers(0, 26, 300))
        for k in range(5):
            texts[len(texts)] = base[: 300 - 40 * k] + "".join(chr(97 + x) for x in rng.integers(0, 26, 40 * k))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: {t[k : k + 4] for k in range(len(t) - 3)} for i, t in texts.items()}
    for threshold, num_perm in ((0.5, 64), (0.6, 128)):
        kept, want = [], {}
        for i in sorted(sets):
            want[i] = next((j for j in kept if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])), None)
            if want[i] is None:
                kept.append(i)
        assert {r["doc_id"]: r["parent"] for r in dedup.near(docs, threshold=threshold, num_perm=num_perm).collect()} == want


def test_funnel_and_configuration(spark):
    assert stats.funnel({"collected": 9, "filtered_out": 2, "exact_duplicates_removed": 1, "near_duplicates_removed": 1}, 4) == [("collected", 9), ("after filter", 7), ("after deduplication", 5), ("kept (final)", 4)]
    assert rules.configured({"min_chars": 3, "other": 1, "__class__": 2}) == rules.FilterConfig(min_chars=3) and rules.configured(None) == rules.FilterConfig()


def test_tables_are_dropped(spark):
    df = storage.written(spark.range(5), "t")
    storage.drop(df)
    assert not os.path.exists(df.written_path.removeprefix("file://"))


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, *args):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        storage.shared_dir(Session())


def test_durations_of_audio_files(spark, tmp_path):
    import wave

    for name, frames in (("a", 8000), ("b", 4000)):
        with wave.open(str(tmp_path / f"{name}.wav"), "wb") as f:
            f.setnchannels(1)
            f.setsampwidth(2)
            f.setframerate(8000)
            f.writeframes(bytes(2 * frames))
    info = bytes(10) + ((16000 << 44) | (0 << 36) | 24000).to_bytes(8, "big") + bytes(16)
    (tmp_path / "c.flac").write_bytes(b"fLaC" + b"\x80\x00\x00\x22" + info)
    (tmp_path / "d.wav").write_bytes(b"no wave")
    found = readers.audio_durations(spark, str(tmp_path))
    assert {r["file_name"]: r["duration_sec"] for r in found.collect()} == {"a.wav": 1.0, "b.wav": 0.5, "c.flac": 1.5, "d.wav": None}
    samples = spark.createDataFrame([("x/a.wav", None), ("x/b.wav", 9.0), ("x/q.wav", None)], "audio_path string, duration_sec double")
    assert {r["audio_path"]: r["duration_sec"] for r in readers.with_durations(samples, found).collect()} == {"x/a.wav": 1.0, "x/b.wav": 9.0, "x/q.wav": None}


def test_report_of_a_run():
    from loomline.sources.sinks import run_report

    page = run_report({"dataset_name": "a<b", "num_records": 3, "stage_stats": {"collected": 5, "filtered_out": 2}, "diversity": {"language_distribution": {"hi": 2, "en": 1}}})
    assert "a&lt;b" in page and "kept (final)" in page and ">hi<" in page and run_report({}).startswith("<!DOCTYPE")
