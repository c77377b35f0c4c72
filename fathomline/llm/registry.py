"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from fathomline.llm import bpe, decontam, langid, licenses, linededup, ngramjoin, quality, tokencounts, topk, toxicity

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_quality": quality.op3_quality,
    "op4_line_dedup": linededup.op4_line_dedup,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_ngram_join": ngramjoin.op6_ngram_join,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_token_counts": tokencounts.op8_token_counts,
    "op9_language_id": langid.op9_language_id,
    "op10_topk": topk.op10_topk,
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": linededup.OP4_SQL,
    "op5_decontamination": decontam.OP5_SQL,
    "op6_ngram_join": ngramjoin.OP6_SQL,
    "op7_license_scan": licenses.OP7_SQL,
    "op10_topk": topk.OP10_SQL,
}
