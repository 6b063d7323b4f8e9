"""Operators of a large-scale training-data pipeline; nothing else in the library imports this subpackage."""

from __future__ import annotations

from . import compaction, fixity, jaccard, langid, media, mixing, packing, quality, recompression, scoring, spelling, suffixes, toxicity


def queries() -> dict:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_lm_scoring": scoring.op2_lm_scoring,
        "op3_media": media.op3_media,
        "op4_jaccard_join": jaccard.op4_jaccard_join,
        "op5_language_id": langid.op5_language_id,
        "op6_substring_dedup": recompression.op6_substring_dedup,
        "op7_quality": quality.op7_quality,
        "op8_warc_fixity": fixity.op8_warc_fixity,
        "op9_packing": packing.op9_packing,
        "op10_suffix_dedup": suffixes.op10_suffix_dedup,
        "op11_spelling": spelling.op11_spelling,
        "op12_compaction": compaction.op12_compaction,
        "op13_toxicity": toxicity.op13_toxicity,
    }


def oracle_sql() -> dict:
    return {"op4_jaccard_join": jaccard.ORACLE, "op6_substring_dedup": recompression.ORACLE, "op8_warc_fixity": fixity.ORACLE, "op11_spelling": spelling.ORACLE}
