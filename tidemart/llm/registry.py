"""Queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import ann_forest, conversation_repair, decontaminate, html_text, jaccard_join, lattice_lm, license_scan, line_dedup, packing, source_divergence, substring_dedup, toxicity, url_filter

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_ann_forest": ann_forest.query,
    "op3_line_dedup": line_dedup.query,
    "op4_jaccard_join": jaccard_join.query,
    "op5_packing": packing.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_html_text": html_text.query,
    "op8_toxicity": toxicity.query,
    "op9_license_scan": license_scan.query,
    "op10_url_filter": url_filter.query,
    "op11_lattice_lm": lattice_lm.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_source_divergence": source_divergence.query,
}
ORACLE = {
    "op1_decontaminate": decontaminate.SQL,
    "op4_jaccard_join": jaccard_join.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op9_license_scan": license_scan.SQL,
    "op10_url_filter": url_filter.SQL,
    "op12_conversation_repair": conversation_repair.SQL,
    "op13_source_divergence": source_divergence.SQL,
}
