"""The corpus queries by name, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from larkspur.llm import bpe, decontaminate, lexical, packing, paragraphs, pseudonyms, quality, simhash, suffixes, topk, toxicity, warc, whitening

QUERIES = {
    "op1_decontamination": decontaminate.query,
    "op2_quality": quality.query,
    "op3_paragraph_classes": paragraphs.query,
    "op4_top_k": topk.query,
    "op5_toxicity": toxicity.query,
    "op6_pseudonyms": pseudonyms.query,
    "op7_simhash_classes": simhash.query,
    "op8_repeated_bytes": suffixes.query,
    "op9_packing": packing.query,
    "op10_warc": warc.query,
    "op11_lexical_search": lexical.query,
    "op12_bpe": bpe.query,
    "op13_whitening": whitening.query,
}

ORACLE_SQL = {
    "op1_decontamination": decontaminate.ORACLE_SQL,
    "op4_top_k": topk.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op11_lexical_search": lexical.ORACLE_SQL,
}
