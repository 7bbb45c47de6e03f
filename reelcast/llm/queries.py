"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from reelcast.llm import (
    block_max_search, bpe_backtrack, chunk_dedup, jaccard_join, kneser_ney, language_evidence, merkle_manifest, pii_boosting,
    positional_index, radix_dedup, simhash_anchors, trigram_secrets, url_automaton)

REGISTRY = {
    "op1_kneser_ney": kneser_ney.op1_kneser_ney,
    "op2_language_evidence": language_evidence.op2_language_evidence,
    "llm_page_language": language_evidence.page_language,
    "op3_chunk_recipes": chunk_dedup.op3_chunk_recipes,
    "op4_adaptive_prefix_join": jaccard_join.op4_adaptive_prefix_join,
    "op5_trigram_secrets": trigram_secrets.op5_trigram_secrets,
    "op6_bpe_backtracking": bpe_backtrack.op6_bpe_backtracking,
    "op7_positional_index": positional_index.op7_positional_index,
    "op8_pii_boosting": pii_boosting.op8_pii_boosting,
    "op9_radix_suffixes": radix_dedup.op9_radix_suffixes,
    "op10_url_filters": url_automaton.op10_url_filters,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_simhash_anchors": simhash_anchors.op12_simhash_anchors,
    "op13_block_max_search": block_max_search.op13_block_max_search,
}


def pipeline(spark, sf_dir: str):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY["pipeline"] = pipeline

SQL = {
    "op3_chunk_recipes": chunk_dedup.ORACLE_SQL,
    "op5_trigram_secrets": trigram_secrets.ORACLE_SQL,
    "op7_positional_index": positional_index.ORACLE_SQL,
    "op10_url_filters": url_automaton.ORACLE_SQL,
    "op11_merkle_manifest": merkle_manifest.ORACLE_SQL,
    "op13_block_max_search": block_max_search.ORACLE_SQL,
}
