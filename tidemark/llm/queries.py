"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import chat, language, lm, mixing, near_vectors, ngram_join, packing, token_counts, topk, toxicity

QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_pack": packing.op2_pack,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_near_vectors": near_vectors.op4_near_vectors,
    "op5_top_k": topk.op5_top_k,
    "op6_chat": chat.op6_chat,
    "op7_language": language.op7_language,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_lm_score": lm.op9_lm_score,
    "op10_toxicity": toxicity.op10_toxicity,
}

ORACLE_SQL = {
    "op1_mix": mixing.SQL,
    "op3_ngram_join": ngram_join.SQL,
    "op4_near_vectors": near_vectors.SQL,
    "op5_top_k": topk.SQL,
    "op6_chat": chat.SQL,
}
