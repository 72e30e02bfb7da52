"""What Python workers and their batches may hold between and within the stages of the corpus pipeline."""

import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from tallyhouse.llm import bpe, language, passages

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_language_drops_the_encoder_left_in_the_worker(spark):
    bpe.encoder()
    assert bpe.encoder.cache_info().currsize == 1
    predict = language.predictor(spark, None)
    assert [list(p["lang"]) for p in predict.func(iter([pd.Series(["a text", None])]))] == [["und", "und"]]
    assert bpe.encoder.cache_info().currsize == 0


@pytest.mark.parametrize(("before", "after"), [("10000", "1000"), ("7", "7"), ("0", "1000")])
def test_pipeline_sends_texts_in_small_batches(spark, before, after):
    spark.conf.set(KEY, before)
    try:
        docs = spark.createDataFrame([(1, "some text of words")], "doc_id bigint, text string")
        sizes = corpus_pipeline.encode(spark, docs, "")
        assert spark.conf.get(KEY) == after
        assert sizes.count() == 1
    finally:
        spark.conf.unset(KEY)


def _texts(n):
    return [" ".join(f"w{(i * 31 + j * j) % 997}" for j in range(60 + i % 40)) for i in range(n)] + [None, "", "too short", "x " * 24]


def test_paragraphs_of_many_texts_come_in_few_batches(monkeypatch):
    texts = _texts(300)
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(len(texts)), pa.int64()), "content": pa.array(range(len(texts)), pa.int64()), "text": texts}
    )
    whole = list(passages._paragraphs(iter([batch])))
    assert len(whole) == 1
    want = [(i, int(s)) for i, t in enumerate(texts) for s in passages.starts_of(passages.shingles_of(t))]
    assert list(zip(whole[0]["doc_id"].to_pylist(), whole[0]["start"].to_pylist())) == want
    monkeypatch.setattr(passages, "_RUN", 1)
    alone = pa.Table.from_batches(passages._paragraphs(iter([batch])))
    assert alone.equals(pa.Table.from_batches(whole))


def test_only_words_of_wanted_paragraphs_are_hashed(monkeypatch):
    texts, hashed = _texts(50)[:50], []
    wanted = [[{"digest": i, "start": i % 30}] for i in range(50)]
    kind = pa.list_(pa.struct([("digest", pa.int64()), ("start", pa.int32())]))
    own = passages._hashed
    monkeypatch.setattr(passages, "_hashed", lambda words: hashed.extend(words) or own(words))
    found = list(passages._sets(iter([pa.RecordBatch.from_pydict({"text": texts, "wanted": pa.array(wanted, kind)})])))
    assert len(found) == 1 and len(hashed) == 50 * passages.PARAGRAPH
    monkeypatch.undo()
    want = [passages.shingles_of(t)[i % 30 : i % 30 + 20].view("int64").tolist() for i, t in enumerate(texts)]
    assert found[0]["shingles"].to_pylist() == want and found[0]["digest"].to_pylist() == list(range(50))
