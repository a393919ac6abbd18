"""One query per operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    fill_middle,
    grid_join,
    jaccard_join,
    mixing,
    packing,
    pii,
    quality,
    quality_rules,
    resampling,
    sentence_dedup,
    tool_calls,
    topk,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": lambda s, d: packing.pack_documents(_table(s, d, "documents")),
        "op2_jaccard_join": lambda s, d: jaccard_join.similar_groups(_table(s, d, "documents")),
        "op3_sentence_spans": lambda s, d: sentence_dedup.repeated_report(_table(s, d, "documents")),
        "op4_top_inner_products": lambda s, d: topk.top_inner_products(_table(s, d, "embeddings")),
        "op5_tool_calls": lambda s, d: tool_calls.format_conversations(_table(s, d, "conversations")),
        "op6_grid_join": lambda s, d: grid_join.near_vectors(_table(s, d, "embeddings")),
        "op7_toxicity": lambda s, d: toxicity.toxicity(_table(s, d, "documents"), _table(s, d, "labels")),
        "op8_mixing": lambda s, d: mixing.mix_report(_table(s, d, "documents")),
        "op9_pii": lambda s, d: pii.pii(_table(s, d, "documents")),
        "op10_quality": lambda s, d: quality.quality(_table(s, d, "documents"), _table(s, d, "labels")),
        "op11_resampling": lambda s, d: resampling.resample(_table(s, d, "documents"), _table(s, d, "benchmark")),
        "op12_fill_middle": lambda s, d: fill_middle.fill_middle_report(_table(s, d, "documents")),
        "op13_quality_rules": lambda s, d: quality_rules.quality_report(_table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_sentence_spans": sentence_dedup.SPANS_SQL,
        "op4_top_inner_products": topk.TOP_SQL,
        "op5_tool_calls": tool_calls.CALLS_SQL,
        "op6_grid_join": grid_join.NEAR_SQL,
        "op8_mixing": mixing.MIX_SQL,
        "op11_resampling": resampling.RESAMPLE_SQL,
        "op12_fill_middle": fill_middle.FIM_SQL,
        "op13_quality_rules": quality_rules.RULES_SQL,
    }
