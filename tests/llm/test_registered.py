"""Registered corpus queries against their SQL, and the pipeline against its stages run plainly."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import difference
from tallyhouse.llm import bpe
from tallyhouse.llm.registry import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return con


def test_registered():
    names = set(contract.queries())
    assert set(llm_queries()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, duck, name):
    assert difference(llm_queries()[name](spark, SF), duck, llm_oracles()[name]) is None


@pytest.mark.parametrize("name", sorted(set(llm_queries()) - set(llm_oracles())))
def test_query_runs(spark, name):
    table = {"op7_pages": "pages", "op11_whitening": "embeddings"}.get(name, "documents")
    rows = llm_queries()[name](spark, SF).count() // (4 if name == "op11_whitening" else 1)
    assert rows == spark.read.parquet(f"{SF}/{table}.parquet").count() or name == "op5_passages"


def brute_pipeline(docs, items):
    """Stages 2 to 5 in plain Python over (doc_id, text); every text here has a language."""
    from test_operators import brute_contamination, brute_lines, simple_components
    from tallyhouse.llm.simhash import fingerprint

    gone = brute_lines(docs)
    left = []
    for i, text in docs:
        lines = text.split("\n")
        kept = "\n".join(x for n, x in enumerate(lines) if (i, n) not in gone)
        if kept == text or kept.strip():
            left.append((i, kept))
    prints = {i: fingerprint(t) for i, t in left}
    ids = sorted(prints)
    close = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 2]
    group = simple_components(ids, close)
    left = [(i, t) for i, t in left if group[i] == i]
    bad = {k[0] for k in brute_contamination(left, items) if k[-1]}
    own = bpe.encoder()
    return {i: bpe.encode_digests(t, own)[1] for i, t in left if i not in bad}


def test_pipeline(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert found == brute_pipeline(docs, items)
