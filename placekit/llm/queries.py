"""The queries ``opN_<name>`` of this subpackage and their DuckDB twins."""

from __future__ import annotations

from placekit.llm.bpe import op2_bpe
from placekit.llm.chat import OP3_SQL, op3_chat_format
from placekit.llm.collocations import OP11_SQL, op11_collocations
from placekit.llm.decontaminate import OP7_SQL, op7_decontaminate
from placekit.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from placekit.llm.line_dedup import op10_line_dedup
from placekit.llm.nearest import op12_nearest
from placekit.llm.ngram_join import op4_ngram_join
from placekit.llm.pii import op5_pii
from placekit.llm.quality import op6_quality_rules
from placekit.llm.suffix_dedup import op8_suffix_dedup
from placekit.llm.token_files import op9_token_files
from placekit.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_chat_format": op3_chat_format,
    "op4_ngram_join": op4_ngram_join,
    "op5_pii": op5_pii,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_nearest": op12_nearest,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_chat_format": OP3_SQL,
    "op7_decontaminate": OP7_SQL,
    "op11_collocations": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
