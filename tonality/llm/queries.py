"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonality.llm import bpe, chatwindows, decontam, exactspans, langid, licenses, linededup, ordinal, periodic, quality, simhash, toxicity, whitening
from tonality.llm.common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactspans.repeated_spans(table(spark, sf_dir, "documents"), size=400).drop("spans")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.classes(table(spark, sf_dir, "documents"), edits=2, min_chars=20)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def byte_bpe_path() -> str:
    """The public byte-level vocabulary that the encoding queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), byte_bpe_path())


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2, seed=42)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatwindows.read_back(chatwindows.windows(chatwindows.with_control_conversation(table(spark, sf_dir, "conversations")), budget=512, history=128))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summary(periodic.with_planted_period(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_suffix_array_dedup, op3_line_dedup, op4_quality_rules, op5_bpe_codec, op6_quality_classifier, op7_toxicity, op8_simhash_near_dedup, op9_language_id, op10_license_scan,
    op11_chat_formatting, op12_embedding_whitening, op13_periodic_runs,
)}
ORACLE: dict[str, str] = {}
