"""Queries of this subpackage: name -> function(spark, sf_dir), and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline

from . import (bpe, conversation_trie, fingerprints, html_extraction, jaccard_join, kd_sharding, language_id,
               mixing, periodic_runs, quality, recompression, simhash, suffix_dedup)

QUERIES = {
    "op1_oph_fingerprints": fingerprints.op1_oph_fingerprints,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_kd_shards": kd_sharding.op3_kd_shards,
    "op4_line_labels": quality.op4_line_labels,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_hd_language_id": language_id.op6_hd_language_id,
    "op7_bpe_codec": bpe.op7_bpe_codec,
    "op8_trie_jaccard_join": jaccard_join.op8_trie_jaccard_join,
    "op9_recompression_dedup": recompression.op9_recompression_dedup,
    "op10_site_style_tree": html_extraction.op10_site_style_tree,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_simhash_golay": simhash.op13_simhash_golay,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {"op2_mix_sources": mixing.ORACLE, "op12_conversation_trie": conversation_trie.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
