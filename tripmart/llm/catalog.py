"""Registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from tripmart.llm.conversations import OP12_SQL, op12_conversation_repair
from tripmart.llm.decontaminate import op4_decontaminate
from tripmart.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from tripmart.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tripmart.llm.line_dedup import op5_line_dedup
from tripmart.llm.packing import op6_packing
from tripmart.llm.quality import op13_quality_rules
from tripmart.llm.simhash import op8_simhash_near_dedup
from tripmart.llm.substring_dedup import OP3_SQL, op3_substring_dedup
from tripmart.llm.token_count import op2_token_counts
from tripmart.llm.token_files import op10_token_files
from tripmart.llm.toxicity import op1_toxicity
from tripmart.llm.url_filter import op9_url_filter

QUERIES = {f.__name__: f for f in (
    op1_toxicity,
    op2_token_counts,
    op3_substring_dedup,
    op4_decontaminate,
    op5_line_dedup,
    op6_packing,
    op7_exact_dedup,
    op8_simhash_near_dedup,
    op9_url_filter,
    op10_token_files,
    op11_hard_negatives,
    op12_conversation_repair,
    op13_quality_rules,
)}

ORACLES: dict[str, str] = {"op7_exact_dedup": OP7_SQL, "op3_substring_dedup": OP3_SQL,
                           "op11_hard_negatives": OP11_SQL, "op12_conversation_repair": OP12_SQL}
