import collections

import pytest

import oracle
from plumbline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_text_query_equals_sql(spark, small, name):
    assert oracle.compare(spark, oracle.connect(small), small, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_mix_sources", "op2_judge_quality", "op5_score_toxicity", "op6_hilbert_shards", "op12_byte_pair_ids"])
def test_query_returns_every_document(spark, small, name):
    ids = [r.doc_id for r in QUERIES[name](spark, small).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect())


def test_pipeline_stages_take_effect(spark, small):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from plumbline.llm.exactdup import exact_duplicates
    from plumbline.llm.neardup import near_duplicates
    from plumbline.llm.toxicity import score_documents
    from plumbline.sources.shared import settled

    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settled(stage(spark, docs, small), f"test-{name}")
        kept[name] = (before, docs)
    rows = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())
    want = {r.doc_id for r in score_documents(kept["toxicity"][0], labels).filter("predicted = 0").collect()}
    assert set(rows(kept["toxicity"][1])) == want
    want = {r.doc_id for r in exact_duplicates(kept["exact_dedup"][0]).filter("kept").collect()}
    assert set(rows(kept["exact_dedup"][1])) == want
    want = {r.doc_id for r in near_duplicates(kept["near_dedup"][0]).filter("kept").collect()}
    assert set(rows(kept["near_dedup"][1])) == want
    before, after = map(rows, kept["mixing"])
    assert set(after) <= set(before) and max(after.values()) <= 2
    assert all(kept[n][1].columns == columns for n in list(kept)[:-1])
    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = collections.Counter()
    for r in kept["packing"][1].collect():
        sizes[r.doc_id] += r.length
    assert sizes == {r.doc_id: after[r.doc_id] * (len(tk.encode(r.text or "", add_special_tokens=False).ids) + 1)
                     for r in kept["packing"][0].dropDuplicates(["doc_id"]).collect()}
