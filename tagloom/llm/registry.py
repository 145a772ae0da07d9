"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from tagloom.llm import (
    collocations, decontaminate, language, line_dedup, lm_score, mixing, periodic, pii, pivot_search, prefix_tree, radix, run_index, toxicity,
)
from tagloom.llm.common import table


def op1_run_index(s, d):
    return run_index.digest(table(s, d, "documents"))


def op2_line_dedup(s, d):
    return line_dedup.digest(table(s, d, "documents"))


def op3_temperature_mixing(s, d):
    return mixing.mix_sources(table(s, d, "documents"))


def op4_decontaminate(s, d):
    return decontaminate.digest(table(s, d, "documents"), table(s, d, "benchmark"))


def op5_prefix_tree(s, d):
    return prefix_tree.jaccard_components(table(s, d, "documents"))


def op6_toxicity(s, d):
    return toxicity.digest(table(s, d, "documents"), table(s, d, "labels"))


def op7_lm_score(s, d):
    return lm_score.digest(table(s, d, "documents"), table(s, d, "labels"))


def op8_language_id(s, d):
    return language.digest(table(s, d, "documents"))


def op9_personal_data(s, d):
    return pii.digest(table(s, d, "documents"))


def op10_pivot_search(s, d):
    return pivot_search.digest(table(s, d, "embeddings"))


def op11_collocations(s, d):
    return collocations.digest(table(s, d, "documents"))


def op12_periodic_runs(s, d):
    return periodic.digest(table(s, d, "documents"))


def op13_radix_dedup(s, d):
    return radix.digest(table(s, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_run_index, op2_line_dedup, op3_temperature_mixing, op4_decontaminate, op5_prefix_tree, op6_toxicity, op7_lm_score,
        op8_language_id, op9_personal_data, op10_pivot_search, op11_collocations, op12_periodic_runs, op13_radix_dedup,
    )
}
ORACLE = {
    "op2_line_dedup": line_dedup.ORACLE, "op3_temperature_mixing": mixing.ORACLE, "op4_decontaminate": decontaminate.ORACLE,
    "op5_prefix_tree": prefix_tree.ORACLE, "op10_pivot_search": pivot_search.ORACLE,
    "op11_collocations": collocations.ORACLE, "op13_radix_dedup": radix.ORACLE,
}
