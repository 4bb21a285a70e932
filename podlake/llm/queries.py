"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from . import chat_format, decontaminate, hard_negatives, line_dedup, lm_scoring, minhash_dedup, packing, pii_tagger, quality_rules, secret_scan, spelling_variants, substring_dedup, warc_index

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_warc_index": warc_index.op2_warc_index,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_pii_tagger": pii_tagger.op4_pii_tagger,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op8_minhash_dedup": minhash_dedup.op8_minhash_dedup,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op6_lm_scoring": lm_scoring.op6_lm_scoring,
    "op7_chat_format": chat_format.op7_chat_format,
    "op11_secret_scan": secret_scan.op11_secret_scan,
    "op12_spelling_variants": spelling_variants.op12_spelling_variants,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op5_line_dedup": line_dedup.SQL,
    "op7_chat_format": chat_format.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
