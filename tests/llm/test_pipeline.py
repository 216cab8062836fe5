"""The corpus pipeline, stage by stage, against brute force."""
import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests_llm_helpers import brute_classes, brute_items, brute_measures

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r.doc_id: r.text for r in documents.collect()}
    outputs, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        outputs[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    texts = {n: {r.doc_id: r.text for r in d.collect()} for n, d in list(outputs.items())[:-1]}
    good = {i: t for i, t in rows.items() if brute_measures(t)}
    assert texts["quality_rules"] == good
    firsts = set(brute_classes(good).values())
    assert texts["simhash_near_dedup"] == {i: good[i] for i in firsts}
    dirty = {d for d, _ in brute_items([(i, good[i]) for i in firsts], items)}
    assert texts["benchmark_decontamination"] == {i: good[i] for i in firsts - dirty}
    assert dirty and texts["pii"].keys() == texts["benchmark_decontamination"].keys()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = set()
    for i, t in texts["pii"].items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in outputs["bpe"].collect()}
    assert got == want
    run = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256) for r in run} == want
