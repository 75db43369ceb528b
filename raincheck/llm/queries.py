"""The registered queries of this package and their DuckDB counterparts."""

from __future__ import annotations

from raincheck.llm import (
    best_fit,
    chat_format,
    conversation_repair,
    decontaminate,
    html_extract,
    line_dedup,
    prefix_trie,
    quality_gam,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    url_filter,
    winnowing,
)
from raincheck.llm.common import ready

_OPERATORS = {
    "op1_line_dedup": line_dedup,
    "op2_substring_dedup": substring_dedup,
    "op3_suffix_array_dedup": suffix_dedup,
    "op4_chat_format": chat_format,
    "op5_url_filter": url_filter,
    "op6_quality_classifier": quality_gam,
    "op7_simhash_near_dedup": simhash_dedup,
    "op8_document_fingerprints": winnowing,
    "op9_benchmark_decontamination": decontaminate,
    "op10_best_fit_packing": best_fit,
    "op11_conversation_repair": conversation_repair,
    "op12_html_extraction": html_extract,
    "op13_conversation_prefix_trie": prefix_trie,
}


def _query(module):
    def run(spark, sf_dir):
        ready(spark)
        return module.query(spark, sf_dir)
    return run


QUERIES = {name: _query(module) for name, module in _OPERATORS.items()}

ORACLE = {name: module.ORACLE for name, module in _OPERATORS.items() if hasattr(module, "ORACLE")}
