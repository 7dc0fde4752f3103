"""The corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

    quality classifier -> line dedup -> SimHash near-dedup -> benchmark decontamination -> BPE

Stages take (spark, docs, sf_dir); all but the last return the columns of
``documents``. A stage's output is written as Parquet and read again before the
next. Documents that the classifier rejects go; line dedup takes repeated lines out
of the texts but leaves every document; of near-duplicates the one with the
smallest id stays; documents that hold a benchmark item go; the last stage
returns a row of token count and digests a document.

Documents with a null id cannot be told apart by an id: the classifier judges them by
their text (rows are scored one by one), line dedup leaves them as they are, the
near-duplicate stage keeps all of them, and decontamination judges each by its text.

A stage may be called by itself, on a session that is not this engine's: each sets how
many texts go to a Python worker at once, which the JVM and the worker both hold.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.llm import bpe, decontam, linededup, ordinal, simhash
from tonality.llm.common import held_out, materialise, table
from tonality.llm.queries import byte_bpe_path
from tonality.session import ENGINE_CONF

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(ROWS, ENGINE_CONF[ROWS])
        return stage(spark, docs, sf_dir)
    return run


@small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ordinal.fit(docs, ordinal.ratings(table(spark, sf_dir, "labels")).where(~held_out()))
    return ordinal.select(docs, model, cut=1, least=0.5)


@small_batches
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup(docs, edits=2, min_chars=20)


@small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=2)


@small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, byte_bpe_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, "pipeline-" + name.replace(" ", "-").lower())
    return docs


#: SQL cannot express the trained stages; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None
