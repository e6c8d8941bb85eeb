"""The training-data queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltaic.llm import bpe, chat, html_text, lm, mixing, packing, pii, quality, runs, simhash, spelling, topk, toxicity
from voltaic.llm.common import table


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(spark, table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(spark, table(spark, sf_dir, "embeddings"))


def op5_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(spark, table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(spark, table(spark, sf_dir, "conversations"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_line_block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_pii_spans, op2_best_fit_packing, op3_byte_bpe, op4_pivot_topk, op5_toxicity_ftrl, op6_simhash_pivots, op7_chat_format, op8_line_quality, op9_bloom_lm, op10_line_block_html, op11_source_mix, op12_periodic_runs, op13_spelling_groups)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_pivot_topk": topk.ORACLE_SQL, "op7_chat_format": chat.ORACLE_SQL, "op8_line_quality": quality.ORACLE_SQL}
