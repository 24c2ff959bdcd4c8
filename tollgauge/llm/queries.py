"""The registered queries of this subpackage: one per operator, over its whole table."""

from tollgauge.llm import (
    conversation_repair, decontamination, language_id, lexical_search, minhash_fingerprints, quality_classifier, quality_rules, simhash_dedup,
    source_mixing, suffix_dedup, token_counts, toxicity, url_filters)

QUERIES = {
    "op1_simhash_near_dedup": simhash_dedup.query,
    "op2_url_filters": url_filters.query,
    "op3_suffix_array_dedup": suffix_dedup.query,
    "op4_toxicity": toxicity.query,
    "op5_token_counts": token_counts.query,
    "op6_benchmark_decontamination": decontamination.query,
    "op7_language_id": language_id.query,
    "op8_quality_rules": quality_rules.query,
    "op9_quality_classifier": quality_classifier.query,
    "op10_source_mixing": source_mixing.query,
    "op11_lexical_search": lexical_search.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_minhash_fingerprints": minhash_fingerprints.query,
}

ORACLES = {
    "op2_url_filters": url_filters.ORACLE,
    "op3_suffix_array_dedup": suffix_dedup.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
}
