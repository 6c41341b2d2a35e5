"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import (chat, decontamination, divergence, exact, extraction, language, lexical, mixing, quality, sharding, simhash,
               toxicity, urls)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_language_id": language.op3_language_id,
    "op4_simhash": simhash.op4_simhash,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_html_extraction": extraction.op6_html_extraction,
    "op7_chat": chat.op7_chat,
    "op8_sharding": sharding.op8_sharding,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_url_filters": urls.op10_url_filters,
    "op11_lexical": lexical.op11_lexical,
    "op12_divergence": divergence.op12_divergence,
    "op13_exact_dedup": exact.op13_exact_dedup,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op7_chat": chat.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op10_url_filters": urls.ORACLE,
    "op11_lexical": lexical.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_exact_dedup": exact.ORACLE,
}
