"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from linkwright.llm.decontamination import OP4_SQL, op4_benchmark_decontamination
from linkwright.llm.language_id import op6_language_id
from linkwright.llm.media import op2_media_columns
from linkwright.llm.packing import op9_best_fit_packing
from linkwright.llm.secrets import op1_secret_scan, op1_sql
from linkwright.llm.sharding import op8_sharding
from linkwright.llm.simhash import op3_simhash_near_dedup
from linkwright.llm.substring_dedup import op10_substring_dedup
from linkwright.llm.token_counts import op5_token_counts
from linkwright.llm.token_files import op7_token_files


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = (
        op1_secret_scan,
        op2_media_columns,
        op3_simhash_near_dedup,
        op4_benchmark_decontamination,
        op5_token_counts,
        op6_language_id,
        op7_token_files,
        op8_sharding,
        op9_best_fit_packing,
        op10_substring_dedup,
        pipeline,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {op1_secret_scan.__name__: op1_sql(), op4_benchmark_decontamination.__name__: OP4_SQL}
