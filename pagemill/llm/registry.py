"""The queries of this folder by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import decontamination, html, licenses, lm, mixing, pii, quality, simhash, suffixes, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        html.op1_html_extraction,
        quality.op2_quality_rules,
        lm.op3_lm_scoring,
        suffixes.op4_suffix_dedup,
        mixing.op5_mix_sources,
        pii.op6_pii,
        decontamination.op7_decontamination,
        simhash.op8_simhash_dedup,
        toxicity.op9_toxicity,
        licenses.op10_license_scan,
        # what SQL can give of two that it can't express as a whole
        quality.quality_base,
        licenses.license_base,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": mixing.ORACLE, "op7_decontamination": decontamination.ORACLE, "quality_base": quality.BASE_ORACLE, "license_base": licenses.BASE_ORACLE}
