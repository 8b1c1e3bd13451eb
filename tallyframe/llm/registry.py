"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyframe.llm import (
    conversations,
    decontamination,
    mixing,
    neardup,
    neighbours,
    pii,
    quality,
    rules,
    secrets,
    tokens,
    toxicity,
    vectorcodes,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": mixing.op1_mix_sources,
        "op2_secret_scan": secrets.op2_secret_scan,
        "op3_near_duplicates": neardup.op3_near_duplicates,
        "op4_decontaminate": decontamination.op4_decontaminate,
        "op5_token_planes": tokens.op5_token_planes,
        "op6_warc_archive": warc.op6_warc_archive,
        "op7_nearest_vectors": neighbours.op7_nearest_vectors,
        "op8_personal_data": pii.op8_personal_data,
        "op9_quality": quality.op9_quality,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_vector_codes": vectorcodes.op11_vector_codes,
        "op12_quality_rules": rules.op12_quality_rules,
        "op13_repair_conversations": conversations.op13_repair_conversations,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": mixing.OP1_SQL,
        "op2_secret_scan": secrets.OP2_SQL,
        "op4_decontaminate": decontamination.OP4_SQL,
        "op6_warc_archive": warc.OP6_SQL,
        "op8_personal_data": pii.OP8_SQL,
        "op11_vector_codes": vectorcodes.OP11_SQL,
        "op13_repair_conversations": conversations.OP13_SQL,
    }
