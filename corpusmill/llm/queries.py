"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from . import (divergence, exact_dedup, filter_audit, jaccard_join, mixing, nearest, pii, piece_codec, quality,
               sharding, suffix_dedup, token_counts, toxicity)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_mixing": mixing.op2_mixing,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_sentencepiece": piece_codec.op6_sentencepiece,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_nearest": nearest.op9_nearest,
    "op10_quality": quality.op10_quality,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_sharding": sharding.op12_sharding,
    "op13_divergence": divergence.op13_divergence,
}

ORACLE = {
    "op2_mixing": mixing.OP2_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op9_nearest": nearest.OP9_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
