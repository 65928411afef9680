"""What workers hold at a time doesn't grow with the batches they are sent."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers

import corpus_pipeline
from loomline.llm import packing, resampling

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [" ".join(f"w{(i * 7 + k) % 500}" for k in range(900)) for i in range(900)]  # 4 MB


def peak_mb(work, batch: pa.RecordBatch) -> tuple[float, list[pa.RecordBatch]]:
    list(work(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        out = list(work(iter([batch])))
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_packing_holds_the_words_of_a_small_chunk(spark, monkeypatch):
    grabbed = []
    monkeypatch.setattr(packing, "in_arrow", lambda df, work, schema: grabbed.append(work) or df)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    packing.pieces(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, **corpus_pipeline.PACKING)
    peak, out = peak_mb(grabbed[0], pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"]))
    ids = [x + [packing.END_ID] for x in ([e.ids for e in packing.WordIds(TOKENIZER).encoder.encode_batch(TEXTS, add_special_tokens=False)])]
    lengths = {}
    for b in out:
        for doc, n in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
            lengths[doc] = lengths.get(doc, 0) + n
    assert lengths == {i: len(x) for i, x in enumerate(ids)}
    assert peak < 50, peak


def test_classifier_holds_the_ngrams_of_a_small_chunk():
    peak, (counts,) = peak_mb(resampling._count, pa.RecordBatch.from_arrays([pa.array([1] * len(TEXTS)), pa.array(TEXTS)], ["quality", "text"]))
    assert counts.column(1).to_numpy().sum() == len(TEXTS) * (900 + 899)
    assert peak < 50, peak


def test_pipeline_remembers_few_words_with_the_same_ids():
    assert corpus_pipeline.PACKING["cache_words"] < packing.CACHE_WORDS
    texts = [" ".join(f"Word{i * 40 + k}," for k in range(40)).encode() for i in range(20)] * 2
    small, large = packing.WordIds(TOKENIZER, cache_words=100), packing.WordIds(TOKENIZER)
    for i in range(0, len(texts), 2):
        for a, b in zip(packing.token_ids(texts[i : i + 2], small), packing.token_ids(texts[i : i + 2], large), strict=True):
            assert np.array_equal(a, b)
        assert len(small.at) <= 100 + 2 * 40 + 1
