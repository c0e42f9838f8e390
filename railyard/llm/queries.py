"""The package's registered queries and their expected results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from railyard.llm import (
    op1_lines, op2_warc, op3_pii, op4_jaccard, op5_quality, op6_lm, op7_toxicity, op8_bpe, op9_decontaminate, op10_language, op11_manifest,
    op12_conversations, op13_factors,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_lines": op1_lines.op1_lines,
        "op1_short_lines": op1_lines.op1_short_lines,
        "op2_warc": op2_warc.op2_warc,
        "op3_pii": op3_pii.op3_pii,
        "op4_jaccard": op4_jaccard.op4_jaccard,
        "op5_quality": op5_quality.op5_quality,
        "op6_lm": op6_lm.op6_lm,
        "op7_toxicity": op7_toxicity.op7_toxicity,
        "op8_bpe": op8_bpe.op8_bpe,
        "op9_decontaminate": op9_decontaminate.op9_decontaminate,
        "op9_near": op9_decontaminate.op9_near,
        "op10_language": op10_language.op10_language,
        "op11_manifest": op11_manifest.op11_manifest,
        "op12_conversations": op12_conversations.op12_conversations,
        "op13_factors": op13_factors.op13_factors,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_lines": op1_lines.ORACLE,
        "op2_warc": op2_warc.ORACLE,
        "op4_jaccard": op4_jaccard.ORACLE,
        "op5_quality": op5_quality.ORACLE,
        "op9_decontaminate": op9_decontaminate.ORACLE,
        "op11_manifest": op11_manifest.ORACLE,
        "op12_conversations": op12_conversations.ORACLE,
    }
