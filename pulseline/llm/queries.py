"""The registered queries of the training-data operators."""

from __future__ import annotations

from pulseline.llm.alignment import op13_tokenizer_alignment
from pulseline.llm.bitsliced import OP11_SQL, op11_exact_topk
from pulseline.llm.chat import OP9_SQL, op9_chat_rotation
from pulseline.llm.codebooks import OP12_SQL, op12_code_compression
from pulseline.llm.fmindex import OP10_SQL, op10_benchmark_decontamination
from pulseline.llm.langid import op6_language_id
from pulseline.llm.licenses import OP2_SQL, op2_license_scan
from pulseline.llm.linedup import OP4_SQL, op4_line_dedup
from pulseline.llm.pieces import op5_sentencepiece
from pulseline.llm.pst import op3_lm_scoring
from pulseline.llm.quality import op8_quality_rules
from pulseline.llm.secrets import op1_secret_scan
from pulseline.llm.simhash import op7_simhash_near_dedup

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_line_dedup": op4_line_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_rotation": op9_chat_rotation,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_exact_topk": op11_exact_topk,
    "op12_code_compression": op12_code_compression,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

SQL: dict[str, str] = {
    "op2_license_scan": OP2_SQL,
    "op4_line_dedup": OP4_SQL,
    "op9_chat_rotation": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_exact_topk": OP11_SQL,
    "op12_code_compression": OP12_SQL,
}
