"""Queries of this subpackage, by the names under which the entry file registers them."""

from __future__ import annotations

from lumbre.llm import class_lm, decontamination, fingerprints, language_id, mixing, near_dedup, preferences, sharding, token_tables, url_rules

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_find_leaks": decontamination.op2_find_leaks,
    "op3_shard_documents": sharding.op3_shard_documents,
    "op4_identify_language": language_id.op4_identify_language,
    "op5_format_preferences": preferences.op5_format_preferences,
    "op6_token_tables": token_tables.op6_token_tables,
    "op7_near_duplicates": near_dedup.op7_near_duplicates,
    "op8_fingerprint_documents": fingerprints.op8_fingerprint_documents,
    "op9_score_documents": class_lm.op9_score_documents,
    "op10_judge_urls": url_rules.op10_judge_urls,
}

#: DuckDB SQL for the same rows; operators that SQL cannot express have none.
ORACLE_SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op5_format_preferences": preferences.OP5_SQL,
    "op7_near_duplicates": near_dedup.OP7_SQL,
    "op10_judge_urls": url_rules.OP10_SQL,
}
