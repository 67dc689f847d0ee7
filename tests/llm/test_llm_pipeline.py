"""The pipeline's stages: columns, decisions, and the whole run against its parts."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from playmart.llm import bpe


def test_stages_are_in_order():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup",
                                                      "source_mixing", "byte_level_bpe"]


def test_run_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != "byte_level_bpe":
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), before.schema)
        if name == "source_mixing":
            kept = docs.collect()
    want = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in docs.collect())
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    assert got == want and len(got) == len(kept) > 50
    codec = bpe.Codec.of(bpe.ranks_path())
    some = sorted((r.doc_id, r.text) for r in kept)[:20]
    digests = {(d, s) for d, _, _, s in got}
    for d, t in some:
        assert (d, hashlib.sha256(codec.decode(codec.encode(t)) if t else b"").hexdigest()) in digests
