"""Queries and SQL of the corpus operators."""

from __future__ import annotations

from seamline.llm import decontaminate, jaccard, language, licences, mixing, passages, pii, quality, toxicity, vectors

_MODULES = {
    "op1_language": (language.op1_language, None),
    "op4_pii": (pii.op4_pii, None),
    "op6_decontaminate": (decontaminate.op6_decontaminate, decontaminate.OP6_SQL),
    "op7_jaccard": (jaccard.op7_jaccard, None),
    "op8_vectors": (vectors.op8_vectors, None),
    "op9_quality": (quality.op9_quality, None),
    "op2_toxicity": (toxicity.op2_toxicity, None),
    "op5_passages": (passages.op5_passages, None),
    "op10_licences": (licences.op10_licences, None),
    "op3_mixing": (mixing.op3_mixing, mixing.OP3_SQL),
}


def queries() -> dict:
    return {name: run for name, (run, _) in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _MODULES.items() if sql}
