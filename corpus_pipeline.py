"""The corpus pipeline: documents in, an entropy-coded token store out.

Each stage calls one operator of ``tidegauge.llm`` on all rows that the stage before it kept; its result is written
as Parquet in the shared folder and read again. Stages but the last return the columns of ``documents``; the last
one returns one row per document of the store, read back from its files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.common import scratch_path, table, write_through
from tidegauge.llm.decontaminate import clean
from tidegauge.llm.mix import mixed_documents
from tidegauge.llm.rans import stored_documents, write_store
from tidegauge.llm.simhash import one_of_each
from tidegauge.llm.toxicity import fit, without_toxic
from tidegauge.llm.vocab import public


#: Different pieces of text that a worker of the last stage keeps encoded, and bytes of text it works on together.
REMEMBERED, AT_ONCE = 100_000, 1 << 19

#: Rows, and their bytes, that Spark hands a worker together; its defaults, 10,000 and 64 MB, are held by Spark and by the worker.
ROWS_AT_ONCE, BYTES_AT_ONCE = 500, 1 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_ROWS, _BYTES = (f"spark.sql.execution.arrow.{name}PerBatch" for name in ("maxRecords", "maxBytes"))


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with these limits set in the session, and left set, as its result is computed later; ``run`` sets them back."""

    @wraps(stage)
    def work(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(_ROWS)) <= ROWS_AT_ONCE:
            spark.conf.set(_ROWS, str(ROWS_AT_ONCE))
        spark.conf.set(_BYTES, str(BYTES_AT_ONCE))
        return stage(spark, docs, sf_dir)

    return work


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones among them, does not call toxic."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, cut or repeated to the words it takes."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the token store."""
    folder = scratch_path(spark, "pipeline-store")
    # the workers still hold what the stages before needed
    write_store(docs, folder, public("word_bpe_49k.json"), remembered=REMEMBERED, at_once=AT_ONCE)
    return stored_documents(spark, folder)


STAGES: list[tuple[str, Stage]] = [
    (stage.__name__, in_small_batches(stage))
    for stage in (toxicity, near_duplicates, decontamination, mixing, token_output)
]

#: SQL can express neither the model nor the file format; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), {key: spark.conf.get(key) for key in (_ROWS, _BYTES)}
    try:
        for name, stage in STAGES:
            docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    return docs
