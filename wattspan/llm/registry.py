"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from wattspan.llm import (
    decontamination,
    jaccard_join,
    packing,
    phrases,
    quality,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    vector_search,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_quality": quality.op6_quality,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_token_files": token_files.op9_token_files,
    "op10_vector_search": vector_search.op10_vector_search,
    "op11_spelling": spelling.op11_spelling,
    "op12_phrases": phrases.op12_phrases,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

ORACLES = {
    "op3_url_filter": url_filter.SQL,
    "op5_decontamination": decontamination.SQL,
    "op12_phrases": phrases.SQL,
}
