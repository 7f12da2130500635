"""Queries opN_<name> of the text operators and their DuckDB oracles."""

from __future__ import annotations

from skewscope.llm import (bwt_dedup, conversation_repair, decontaminate, embedding_dedup, imatch, lm_score, minhash,
                           packing, periodic_runs, pii, quality, secret_links, url_rules)

QUERIES = {
    "op1_bbit_minhash": minhash.op1_bbit_minhash,
    "op2_bm25_packing": packing.op2_bm25_packing,
    "op3_cross_entropy": lm_score.op3_cross_entropy,
    "op4_weak_pii": pii.op4_weak_pii,
    "op5_positional_index": decontaminate.op5_positional_index,
    "op6_bwt_repeats": bwt_dedup.op6_bwt_repeats,
    "op7_imatch": imatch.op7_imatch,
    "op8_secret_links": secret_links.op8_secret_links,
    "op9_url_rules": url_rules.op9_url_rules,
    "op10_quality_gam": quality.op10_quality_gam,
    "op11_suffix_automaton": conversation_repair.op11_suffix_automaton,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_cross_polytope": embedding_dedup.op13_cross_polytope,
}
ORACLE_SQL = {
    "op1_bbit_minhash": minhash.SQL.strip(),
    "op5_positional_index": decontaminate.SQL.strip(),
    "op6_bwt_repeats": bwt_dedup.SQL.strip(),
    "op7_imatch": imatch.SQL.strip(),
    "op9_url_rules": url_rules.SQL.strip(),
    "op11_suffix_automaton": conversation_repair.SQL.strip(),
    "op13_cross_polytope": embedding_dedup.SQL.strip(),
}
