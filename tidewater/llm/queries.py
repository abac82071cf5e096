"""Queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from . import (bpe, decontaminate, lines, negatives, neighbours, phrases, quality, sharding, simhash, substrings,
               token_store, topk, toxicity)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_simhash": simhash.op4_simhash,
    "op5_token_store": token_store.op5_token_store,
    "op6_bpe": bpe.op6_bpe,
    "op7_substrings": substrings.op7_substrings,
    "op8_quality": quality.op8_quality,
    "op9_nearest": neighbours.op9_nearest,
    "op10_lines": lines.op10_lines,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_topk": topk.op12_topk,
    "op13_phrases": phrases.op13_phrases,
}

ORACLES = {
    "op3_decontamination": decontaminate.OP3_SQL,
    "op7_substrings": substrings.OP7_SQL,
    "op9_nearest": neighbours.OP9_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_topk": topk.OP12_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
