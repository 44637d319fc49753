"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pricelens.llm import (
    bpe, cover_tree, decontamination, hard_negatives, jaccard, language_id, line_dedup, quality,
    sharding, spelling, token_counts, toxicity, url_filters)


def llm_queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_jaccard": jaccard.op3_jaccard,
        "op4_cover_tree": cover_tree.op4_cover_tree,
        "op5_decontamination": decontamination.op5_decontamination,
        "op6_toxicity": toxicity.op6_toxicity,
        "op8_quality": quality.op8_quality,
        "op7_sharding": sharding.op7_sharding,
        "op9_bpe": bpe.op9_bpe,
        "op10_url_filters": url_filters.op10_url_filters,
        "op11_language_id": language_id.op11_language_id,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_spelling": spelling.op13_spelling,
    }


def llm_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op10_url_filters": url_filters.SQL,
            "op12_hard_negatives": hard_negatives.SQL}
