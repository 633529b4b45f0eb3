"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from candlewick.llm import (byte_bpe, conversation_repair, disclosure, hamming, html_text, language_id,
                            lexical_search, minhash, packing, quality, sharding, token_output, warc)

QUERIES = {
    "op1_proportional_interleave": sharding.op1_proportional_interleave,
    "op2_tree_scoring": html_text.op2_tree_scoring,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_multi_index_hashing": hamming.op4_multi_index_hashing,
    "op5_warc_salvage": warc.op5_warc_salvage,
    "op6_best_two_fit": packing.op6_best_two_fit,
    "op7_disclosure": disclosure.op7_disclosure,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_feistel_shards": token_output.op9_feistel_shards,
    "op10_superminhash": minhash.op10_superminhash,
    "op11_glr_repair": conversation_repair.op11_glr_repair,
    "op12_subword_softmax": language_id.op12_subword_softmax,
    "op13_pipelined_terms": lexical_search.op13_pipelined_terms,
}

SQL: dict[str, str] = {
    "op4_multi_index_hashing": hamming.SQL,
    "op5_warc_salvage": warc.SQL,
    "op8_quality_rules": quality.SQL,
    "op11_glr_repair": conversation_repair.SQL,
    "op13_pipelined_terms": lexical_search.SQL,
}
