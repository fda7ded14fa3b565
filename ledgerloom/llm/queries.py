"""The queries of this subpackage: opN_<name> for each operator N, with SQL where SQL can express it."""

from __future__ import annotations

from . import chosen_path, hard_negatives, importance, language_id, line_dedup, main_text, media, packing, piece_codec, quality_rules, substring_dedup, token_files, url_filters

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_language_id": language_id.query,
    "op3_piece_codec": piece_codec.query,
    "op4_quality_rules": quality_rules.query,
    "op5_url_filters": url_filters.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_media_columns": media.query,
    "op8_token_files": token_files.query,
    "op9_packing": packing.query,
    "op10_chosen_path_join": chosen_path.query,
    "op11_importance_resampling": importance.query,
    "op12_main_text": main_text.query,
    "op13_hard_negatives": hard_negatives.query,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_url_filters": url_filters.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op11_importance_resampling": importance.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
