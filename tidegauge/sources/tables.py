"""Time-partitioned event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions

DATE = "event_date"
BATCH = "batch_id"


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, F.to_date("event_time"))


def append_scored(batch: DataFrame, batch_id: int, path: str) -> None:
    """Add one micro-batch of scored rows to the landing table.

    Each batch has folders of its own below each date, so that a batch that is run again replaces
    its rows and date filters still prune.
    """
    _dated(batch).withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(DATE, BATCH).parquet(path)


def write_event_table(
    df: DataFrame, path: str, sort_by: Sequence[str], files: int | None = None, mode: str = "overwrite"
) -> None:
    """Write the query layout: a folder per date, rows sorted so that file statistics prune.

    The range partitioning cuts the rows evenly by (date, ``sort_by``): a date with a third of all
    rows becomes many files, and a file spans few keys.
    """
    dated = _dated(df)
    by = [DATE, *sort_by]
    ranged = dated.repartitionByRange(files, *by) if files else dated.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode(mode).partitionBy(DATE).parquet(path)


def write_anomaly_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The flagged rows on their own, by date: what the partial index on the flag is for."""
    flagged = _dated(df.where("is_anomaly"))
    flagged.sortWithinPartitions(DATE, "event_time").write.mode(mode).partitionBy(DATE).parquet(path)


def read_event_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows with ``event_date``, ready for ``time_filter``."""
    stored = T.StructType([*schema.fields, T.StructField(DATE, T.DateType())])
    return spark.read.schema(stored).parquet(path)


ROWS_PER_FILE = 5_000_000


def land_scored(batch: DataFrame, batch_id: int, path: str) -> bool:
    """Add one micro-batch to a table that is compacted later, exactly once; whether it was new.

    Batches have even runs: between two of them is room for a compaction.
    """
    spark, run = batch.sparkSession, 2 * batch_id
    versions.create(spark, path, batch.schema)
    if versions.committed(spark, path, run):
        return False
    versions.publish(batch, path, F.to_date("event_time"), run)
    return True


def read_landed(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The rows of all committed batches with ``event_date``, ready for ``time_filter``."""
    rows = versions.read(spark, path, schema, before=before)
    return rows.withColumn(DATE, F.col(versions.PART).cast("date")).drop(versions.PART)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sort_by: Sequence[str],
    last_batch: int,
    closed_before: str,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Replace the files that batches up to ``last_batch`` left in the dates before ``closed_before``.

    The rows of these dates are range-partitioned by (date, ``sort_by``) into files of ``rows_per_file``, one file
    per date at least, and published as one run. Readers see the old files or the new ones; a failed write
    leaves the old ones. Run ``versions.expire`` when no reader of the old files is left.
    """
    run = 2 * last_batch + 1
    if versions.committed(spark, path, run):
        return
    closed = versions.read(spark, path, schema, F.col(versions.PART) < closed_before, before=run)
    files = max(1, -(-closed.count() // rows_per_file))
    by = [versions.PART, *sort_by]
    ranged = closed.repartitionByRange(files, *by).sortWithinPartitions(*by)
    parts = closed.select(versions.PART).distinct()
    versions.publish(ranged, path, F.col(versions.PART), run, True, parts, arranged=True)
