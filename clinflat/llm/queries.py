"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.llm import (
    byte_bpe,
    chat_format,
    exact_dedup,
    hard_negatives,
    line_dedup,
    lm_scoring,
    mixing,
    periodic_runs,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
    warc,
)
from clinflat.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = _tokenizer("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_folder(spark)
    token_files.write_ids(table(spark, sf_dir, "documents"), path, _tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_files.read_ids(spark, path, with_ids=False)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_archive(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.expr("try_cast(page_id AS long)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to AS long)").alias("refers_to"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    awkward = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_format.chat_report(chat_format.format_chats(turns.unionByName(awkward)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    looped = periodic_runs.with_stutter(table(spark, sf_dir, "documents"))
    return periodic_runs.run_report(periodic_runs.find_runs(looped))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_files": op7_token_files,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op5_quality_rules": quality_rules.SQL,
    "op10_warc": warc.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_chat_format": chat_format.SQL,
}
