"""Registered queries of this subpackage and their DuckDB twins.

Operators 3, 8, 9 and 10 have no twin: tokenizer merges, greedy packing, SimHash votes and CRC-32
are not SQL; tests/llm holds them against the library, brute force or their laws.
"""

from __future__ import annotations

from spikeloom.llm import decontam, hardneg, langid, neardup, packing, quality, repair, secrets, shards, substr, tokens, urls, warc

QUERIES = {
    "op1_minhash_near_dedup": neardup.op1,
    "op2_warc_revisits": warc.op2,
    "op3_token_counts": tokens.op3,
    "op4_secret_scans": secrets.op4,
    "op5_substring_dedup": substr.op5,
    "op6_quality_rules": quality.op6,
    "op7_url_filters": urls.op7,
    "op8_best_fit_packing": packing.op8,
    "op9_benchmark_decontamination": decontam.op9,
    "op10_sharding": shards.op10,
    "op11_conversation_repair": repair.op11,
    "op12_hard_negatives": hardneg.op12,
    "op13_language_id": langid.op13,
}
ORACLES = {
    "op1_minhash_near_dedup": neardup.OP1_SQL,
    "op2_warc_revisits": warc.OP2_SQL,
    "op4_secret_scans": secrets.OP4_SQL,
    "op5_substring_dedup": substr.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op7_url_filters": urls.OP7_SQL,
    "op12_hard_negatives": hardneg.OP12_SQL,
}
