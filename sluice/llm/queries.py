"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from sluice.llm import (
    collocations, contamination, embeddings, langid, lm_scoring, mixing, neardup, passages, pii, resampling, sharding, token_counts, toxicity,
)

QUERIES = {
    "op1_pareto_mix": mixing.op1_pareto_mix,
    "op2_bm25_decontamination": contamination.op2_bm25_decontamination,
    "op3_personal_data": pii.op3_personal_data,
    "op4_minhash_near_dup": neardup.op4_minhash_near_dup,
    "op5_repeated_passages": passages.op5_repeated_passages,
    "op6_cross_entropy_difference": lm_scoring.op6_cross_entropy_difference,
    "op7_embedding_links": embeddings.op7_embedding_links,
    "op8_language_id": langid.op8_language_id,
    "op9_histogram_shards": sharding.op9_histogram_shards,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_token_counts": token_counts.op13_token_counts,
}

ORACLE = {
    "op1_pareto_mix": mixing.ORACLE,
    "op2_bm25_decontamination": contamination.ORACLE,
    "op4_minhash_near_dup": neardup.ORACLE,
    "op5_repeated_passages": passages.ORACLE,
    "op6_cross_entropy_difference": lm_scoring.ORACLE,
    "op7_embedding_links": embeddings.ORACLE,
    "op9_histogram_shards": sharding.ORACLE,
    "op11_importance_resampling": resampling.ORACLE,
    "op12_phrase_collocations": collocations.ORACLE,
}
