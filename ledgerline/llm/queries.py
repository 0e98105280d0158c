"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import brown, decontaminate, html_template, line_dedup, pieces, quality, simhash, tiff, token_counts, toxicity

QUERIES = {
    "op8_html_template": html_template.query,
    "op2_token_counts": token_counts.query,
    "op3_pieces": pieces.query,
    "op5_tiff": tiff.query,
    "op1_brown_lm": brown.query,
    "op4_toxicity": toxicity.query,
    "op7_quality_ftrl": quality.query,
    "op6_simhash": simhash.query,
    "op9_decontaminate": decontaminate.query,
    "op10_line_dedup": line_dedup.query,
}

SQL = {
    "op9_decontaminate": decontaminate.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
