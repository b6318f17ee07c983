"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from vaportrail.llm.decontamination import OP9_SQL, op9_benchmark_decontamination
from vaportrail.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from vaportrail.llm.html import op3_main_text
from vaportrail.llm.language_model import op5_language_model
from vaportrail.llm.line_duplicates import OP4_SQL, op4_line_duplicates
from vaportrail.llm.near_duplicates import OP2_SQL, op2_near_duplicates
from vaportrail.llm.packing import op10_best_fit_packing
from vaportrail.llm.personal_data import op8_personal_data
from vaportrail.llm.quality import op6_quality_rules
from vaportrail.llm.repeated_substrings import op7_repeated_substrings
from vaportrail.llm.shared import importable
from vaportrail.llm.simhash import op13_simhash_duplicates
from vaportrail.llm.toxicity import op1_toxicity
from vaportrail.llm.whitening import op11_embedding_whitening


def _ready(query):
    def ready(spark, folder):
        importable(spark)
        return query(spark, folder)

    return ready


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_main_text": op3_main_text,
    "op4_line_duplicates": op4_line_duplicates,
    "op5_language_model": op5_language_model,
    "op6_quality_rules": op6_quality_rules,
    "op7_repeated_substrings": op7_repeated_substrings,
    "op8_personal_data": op8_personal_data,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash_duplicates": op13_simhash_duplicates,
}
QUERIES = {name: _ready(query) for name, query in QUERIES.items()}

ORACLE = {
    "op2_near_duplicates": OP2_SQL,
    "op4_line_duplicates": OP4_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op12_hard_negatives": OP12_SQL,
}
