"""Queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from . import chat_formatting, decontamination, exact_dedup, extendible_sharding, hard_negatives, license_scan, ngram_join, packing, quality_classifier, quality_rules, secret_scan, substring_dedup, whitening


def queries() -> dict:
    return {
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_suffix_dedup": substring_dedup.op2_suffix_dedup,
        "op3_packing": packing.op3_packing,
        "op4_quality_classifier": quality_classifier.op4_quality_classifier,
        "op5_extendible_sharding": extendible_sharding.op5_extendible_sharding,
        "op6_decontamination": decontamination.op6_decontamination,
        "op7_secret_scan": secret_scan.op7_secret_scan,
        "op8_ngram_join": ngram_join.op8_ngram_join,
        "op9_quality_rules": quality_rules.op9_quality_rules,
        "op10_chat_formatting": chat_formatting.op10_chat_formatting,
        "op11_exact_dedup": exact_dedup.op11_exact_dedup,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_embedding_whitening": whitening.op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.OP1_SQL,
        "op2_suffix_dedup": substring_dedup.OP2_SQL,
        "op5_extendible_sharding": extendible_sharding.OP5_SQL,
        "op6_decontamination": decontamination.OP6_SQL,
        "op8_ngram_join": ngram_join.OP8_SQL,
        "op10_chat_formatting": chat_formatting.OP10_SQL,
        "op11_exact_dedup": exact_dedup.OP11_SQL,
        "op12_hard_negatives": hard_negatives.OP12_SQL,
    }
