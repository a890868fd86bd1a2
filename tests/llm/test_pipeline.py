import zlib

import corpus_pipeline
import numpy as np
from brute import components

from clickweave.llm import simhash, token_store
from clickweave.llm.queries import ORACLE_SQL, QUERIES, op1_ball_tree, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages(documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near-duplicates", "benchmark", "mixing", "tokens"]


def test_near_duplicate_stage_keeps_one_of_each_group(shipped, documents):
    rows = documents.select("doc_id", "text").collect()
    bits = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    group = components(sorted(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 2)
    kept = corpus_pipeline.drop_near_duplicates(shipped, documents, SF)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))


def test_stages_on_odd_and_empty_tables(shipped, documents, odd_documents):
    for docs in (odd_documents, documents.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(shipped, docs, SF)
            assert out.columns == docs.columns
            assert all(r["_key"] == r.n_chars == r.score for r in out.collect() if "_key" in docs.columns)
            texts = {r.text for r in out.select("text").collect()}
            assert texts <= {r.text for r in docs.select("text").collect()}
    kept = corpus_pipeline.drop_near_duplicates(shipped, odd_documents, SF).collect()
    assert len([r for r in kept if r.doc_id == 1]) == 1


def test_run(shipped, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(shipped, docs, SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = corpus_pipeline.run(shipped, SF).orderBy("start").collect()
    tokenizer = token_store._tokenizer(tokenizer_path())
    assert got and {r.doc_id for r in got} == set(texts) and [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    at = 0
    for r in got:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_queries_are_registered(shipped):
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = duckdb.sql(ORACLE_SQL["op1_ball_tree"]).fetchall()
    got = op1_ball_tree(shipped, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)
