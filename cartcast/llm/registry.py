"""Registered queries of the corpus operators (name -> function, SQL twin)."""

from __future__ import annotations

from .alignment import op12_token_alignment
from .bpe import op5_bpe
from .dialogue import op11_conversation_repair
from .langid import op2_language_id
from .packing import op8_best_fit_packing
from .quality import op4_quality_rules
from .repair import op7_token_files
from .rollups import OP9_SQL, op9_token_counts
from .simhash import op3_simhash_near_dedup
from .sketch import op6_document_fingerprints
from .suffixes import op1_suffix_dedup
from .toxicity import op10_toxicity
from .wordshuffle import op13_word_shuffle_bpe

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe": op5_bpe,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_token_files": op7_token_files,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_alignment": op12_token_alignment,
    "op13_word_shuffle_bpe": op13_word_shuffle_bpe,
}

ORACLE: dict[str, str] = {"op9_token_counts": OP9_SQL}
