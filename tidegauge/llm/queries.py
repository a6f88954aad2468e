"""The registered queries of this subpackage and the SQL that checks them, where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.alignment import op11_token_alignment
from tidegauge.llm.decontaminate import op5_benchmark_decontamination
from tidegauge.llm.manifest import ORACLE_SQL as MANIFEST_SQL
from tidegauge.llm.manifest import op12_merkle_manifest
from tidegauge.llm.mix import op1_source_mix
from tidegauge.llm.neighbours import op3_nearest_neighbours
from tidegauge.llm.pii import op2_personal_data
from tidegauge.llm.quality import op6_quality_classifier
from tidegauge.llm.rans import op7_token_store
from tidegauge.llm.simhash import op4_simhash_dedup
from tidegauge.llm.smallworld import op13_embedding_dedup
from tidegauge.llm.substring import op10_substring_dedup
from tidegauge.llm.tokencount import op8_token_counts
from tidegauge.llm.toxicity import op9_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_personal_data": op2_personal_data,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_store": op7_token_store,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLES: dict[str, str] = {"op12_merkle_manifest": MANIFEST_SQL}
