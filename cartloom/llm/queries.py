"""Registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from cartloom.llm.chat import OP6_SQL, op6_chat
from cartloom.llm.decontaminate import op10_decontaminate
from cartloom.llm.extract import op5_extract
from cartloom.llm.fingerprint import op9_fingerprint
from cartloom.llm.language import op12_language
from cartloom.llm.lmscore import op4_lm_score
from cartloom.llm.manifest import OP13_SQL, op13_merkle
from cartloom.llm.minhash import op3_minhash
from cartloom.llm.mixture import OP1_SQL, op1_mix
from cartloom.llm.negatives import OP11_SQL, op11_hard_negatives
from cartloom.llm.recompress import op7_substring_dedup
from cartloom.llm.suffixes import op2_suffix_dedup
from cartloom.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_mix": op1_mix,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash": op3_minhash,
    "op4_lm_score": op4_lm_score,
    "op5_extract": op5_extract,
    "op6_chat": op6_chat,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_fingerprint": op9_fingerprint,
    "op10_decontaminate": op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language": op12_language,
    "op13_merkle": op13_merkle,
}
ORACLES = {"op1_mix": OP1_SQL, "op6_chat": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op13_merkle": OP13_SQL}
