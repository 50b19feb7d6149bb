"""The queries of this folder and the SQL counterparts of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from firmalign.llm import (
    archive, coder, decontam, lines, neardup, neighbours, packing, pii, ranking, sharding, templates, toxicity,
    variants)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack": packing.op1_pack,
        "op2_pii": pii.op2_pii,
        "op3_token_files": coder.op3_token_files,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_shard": sharding.op5_shard,
        "op6_decontaminate": decontam.op6_decontaminate,
        "op7_near_duplicates": neardup.op7_near_duplicates,
        "op8_main_text": templates.op8_main_text,
        "op9_warc": archive.op9_warc,
        "op10_line_quality": lines.op10_line_quality,
        "op11_ranked_search": ranking.op11_ranked_search,
        "op12_quality": neighbours.op12_quality,
        "op13_spelling_variants": variants.op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_ranked_search": ranking.ORACLE_SQL}
