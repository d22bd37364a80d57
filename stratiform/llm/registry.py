"""The subpackage's queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.decontamination import op4_simhash_decontamination
from stratiform.llm.language_model import op3_elias_fano_lm
from stratiform.llm.near_dedup import op8_minhash_near_duplicates
from stratiform.llm.oracles import OP4, OP7, OP8
from stratiform.llm.packing import op10_sum_of_squares_packing
from stratiform.llm.quality_classifier import op5_attention_mil_quality
from stratiform.llm.quality_rules import op6_kneser_ney_rules
from stratiform.llm.secrets import op2_assignment_secrets
from stratiform.llm.sharding import op1_kd_tree_shards
from stratiform.llm.suffix_dedup import op7_suffix_array_repeats
from stratiform.llm.token_files import op9_ranked_varbyte_ids

_QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_kd_tree_shards,
    op2_assignment_secrets,
    op3_elias_fano_lm,
    op4_simhash_decontamination,
    op5_attention_mil_quality,
    op6_kneser_ney_rules,
    op7_suffix_array_repeats,
    op8_minhash_near_duplicates,
    op9_ranked_varbyte_ids,
    op10_sum_of_squares_packing,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {op4_simhash_decontamination.__name__: OP4, op7_suffix_array_repeats.__name__: OP7, op8_minhash_near_duplicates.__name__: OP8}
