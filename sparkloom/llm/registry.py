"""Queries of this subpackage, by name, and the SQL that gives the same rows."""

from . import bpe, decontaminate, divergence, exact_dedup, line_dedup, lm_score, minhash, neighbours, pii, quality, substring_dedup, toxicity, whitening

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
    "op4_lm_scoring": lm_score.op4_lm_scoring,
    "op5_quality": quality.op5_quality,
    "op6_minhash_near_dedup": minhash.op6_minhash_near_dedup,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_bpe_round_trip": bpe.op9_bpe_round_trip,
    "op10_pii": pii.op10_pii,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_nearest_neighbours": neighbours.op12_nearest_neighbours,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_minhash_near_dedup": minhash.ORACLE_SQL,
    "op7_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
}
