"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from coursemill.llm import (
    alignment,
    bytebpe,
    conversations,
    fixity,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    sketches,
    substrings,
    tokens,
    toxicity,
)

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_token_files": tokens.query,
    "op3_personal_data": pii.query,
    "op4_mixing": mixing.query,
    "op5_substrings": substrings.query,
    "op6_packing": packing.query,
    "op7_toxicity": toxicity.query,
    "op8_quality_rules": quality.query,
    "op9_fingerprints": sketches.query,
    "op10_warc_fixity": fixity.query,
    "op11_alignment": alignment.query,
    "op12_byte_bpe": bytebpe.query,
    "op13_conversations": conversations.query,
}

ORACLE = {
    "op3_personal_data": pii.SQL,
    "op4_mixing": mixing.SQL,
    "op5_substrings": substrings.SQL,
    "op8_quality_rules": quality.SQL,
    "op10_warc_fixity": fixity.SQL,
    "op13_conversations": conversations.SQL,
}
