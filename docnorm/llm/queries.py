"""Registered queries of the operators and the DuckDB SQL of those that SQL can express."""
from __future__ import annotations

from docnorm.llm import alignment, chat, language, merkle, mixing, near_dup, packing, periodic_runs, quality, suffix_dedup, tiered_packing, top_k, training_order

QUERIES = {
    "op1_pack_best_fit": packing.op1_pack_best_fit,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_bit_sliced_top_k": top_k.op3_bit_sliced_top_k,
    "op4_training_order": training_order.op4_training_order,
    "op5_chat_format": chat.op5_chat_format,
    "op6_language_centroids": language.op6_language_centroids,
    "op7_minhash_near_dup": near_dup.op7_minhash_near_dup,
    "op8_merkle_fingerprints": merkle.op8_merkle_fingerprints,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_ordinal_quality": quality.op10_ordinal_quality,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_tiered_packing": tiered_packing.op13_tiered_packing,
}

ORACLE = {
    "op3_bit_sliced_top_k": top_k.ORACLE_SQL,
    "op5_chat_format": chat.ORACLE_SQL,
    "op7_minhash_near_dup": near_dup.ORACLE_SQL,
    "op8_merkle_fingerprints": merkle.ORACLE_SQL,
    "op9_mix_sources": mixing.ORACLE_SQL,
}
