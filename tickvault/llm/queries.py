"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tickvault.llm.collocations import OP12_SQL, op12_collocations
from tickvault.llm.decontaminate import OP8_SQL, op8_decontamination
from tickvault.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tickvault.llm.html_extraction import op5_html_extraction
from tickvault.llm.jaccard_join import OP7_SQL, op7_jaccard_join
from tickvault.llm.language_id import op9_language_id
from tickvault.llm.line_dedup import OP2_SQL, op2_line_dedup
from tickvault.llm.mixing import op1_source_mixing
from tickvault.llm.quality_classifier import op3_quality_classifier
from tickvault.llm.quality_rules import op10_quality_rules
from tickvault.llm.sentence_pieces import op13_sentence_pieces
from tickvault.llm.substring_dedup import OP6_SQL, op6_substring_dedup
from tickvault.llm.suffix_dedup import op4_suffix_dedup

QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_line_dedup, op3_quality_classifier, op4_suffix_dedup, op5_html_extraction,
    op6_substring_dedup, op7_jaccard_join, op8_decontamination, op9_language_id, op10_quality_rules,
    op11_hard_negatives, op12_collocations, op13_sentence_pieces)}
ORACLES = {"op2_line_dedup": OP2_SQL, "op6_substring_dedup": OP6_SQL, "op7_jaccard_join": OP7_SQL,
           "op8_decontamination": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_collocations": OP12_SQL}
