"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from claimsflow.llm.chat import OP4_SQL, op4_chat_rotation
from claimsflow.llm.decontaminate import op5_decontaminate
from claimsflow.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from claimsflow.llm.language import language_of_pages, op6_language_id
from claimsflow.llm.language_model import op2_lm_scoring
from claimsflow.llm.line_runs import OP12_SQL, op12_line_dedup
from claimsflow.llm.mixing import OP1_SQL, op1_source_mix
from claimsflow.llm.near_duplicates import op3_jaccard_join
from claimsflow.llm.pii import op8_pii
from claimsflow.llm.quality import op7_quality_rules
from claimsflow.llm.toxicity import op10_toxicity
from claimsflow.llm.urls import op9_url_rules
from claimsflow.llm.variants import OP13_SQL, op13_spelling_variants

QUERIES = {f.__name__: f for f in (
    op1_source_mix, op2_lm_scoring, op3_jaccard_join, op4_chat_rotation, op5_decontaminate, op6_language_id, op7_quality_rules,
    op8_pii, op9_url_rules, op10_toxicity, op11_hard_negatives, op12_line_dedup, op13_spelling_variants, language_of_pages)}

SQL: dict[str, str] = {"op1_source_mix": OP1_SQL, "op4_chat_rotation": OP4_SQL, "op11_hard_negatives": OP11_SQL,
                       "op12_line_dedup": OP12_SQL, "op13_spelling_variants": OP13_SQL}
