"""Queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from isoforge.llm import exact_dedup, jaccard_join, lang_id, license_scan, packing, source_mixing, substring_dedup, suffix_repeats, token_counts, toxicity


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_suffix_repeats": suffix_repeats.op1_suffix_repeats,
        "op2_lang_id": lang_id.op2_lang_id,
        "op3_license_scan": license_scan.op3_license_scan,
        "op4_packing": packing.op4_packing,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_token_counts": token_counts.op6_token_counts,
        "op7_source_mixing": source_mixing.op7_source_mixing,
        "op8_substring_dedup": substring_dedup.op8_substring_dedup,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jaccard_join": jaccard_join.ORACLE,
        "op7_source_mixing": source_mixing.ORACLE,
        "op8_substring_dedup": substring_dedup.ORACLE,
        "op9_exact_dedup": exact_dedup.ORACLE,
    }
