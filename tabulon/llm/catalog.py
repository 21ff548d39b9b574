"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tabulon.llm import (bpe, collocations, digest_index, hard_negatives, html_main, jaccard_join, kd_shards, line_dedup,
                         mixing, quality_outliers, token_count, toxicity, url_filter)

_QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_bpe": bpe.op2_bpe,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality_outliers": quality_outliers.op4_quality_outliers,
    "op5_kd_shards": kd_shards.op5_kd_shards,
    "op6_exact_dedup": digest_index.op6_exact_dedup,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_mixing": mixing.op9_mixing,
    "op10_html_main": html_main.op10_html_main,
    "op11_token_counts": token_count.op11_token_counts,
    "op12_collocations": collocations.op12_collocations,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
_ORACLES = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op6_exact_dedup": digest_index.OP6_SQL,
    "op7_jaccard_join": jaccard_join.OP7_SQL,
    "op8_url_filter": url_filter.OP8_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return {k: v.strip() for k, v in _ORACLES.items()}
