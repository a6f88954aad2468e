"""Tables that change part by part, with one record per change that makes it visible.

A run writes rows into folders of its own, ``rows/part=<part>/run=<run>``, and then one commit: the parts it wrote
and whether it replaces what they held. Readers go by the commits alone, so a reader sees a run whole or not at all,
a failed run leaves everything as it was, and a run that is repeated finds its commit. What a commit replaced
stays for readers that began before it, until ``expire`` removes it.

Runs have increasing numbers and one writer at a time. A part is a date, an hour or a hash bucket: commits have one
row for each part a run touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, RUN = "part", "run"
LOOKUP_ROWS = 1_000_000  # most commit rows that are broadcast

_COMMITS = "part string, replaces boolean, entry string, upto timestamp"


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table; one that is there stays."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/rows")
    spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{path}/commits")


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and touched part, and the notes of runs (rows without a part)."""
    return spark.read.schema(f"{_COMMITS}, {RUN} long").parquet(f"{path}/commits").where(F.col(RUN) >= 0)


def committed(spark: SparkSession, path: str, run: int) -> bool:
    return not commits(spark, path).where(F.col(RUN) == run).isEmpty()


def publish(
    df: DataFrame,
    path: str,
    part: Column,
    run: int,
    replaces: bool = False,
    parts: DataFrame | None = None,
    notes: DataFrame | None = None,
    arranged: bool = False,
) -> None:
    """Write ``df`` as a run and commit it.

    ``parts`` names all parts of the run, those left without rows, too; without it they are read back from what
    was written. ``notes`` are ``entry`` and ``upto`` rows to keep with the commit. Rows are dealt out by part,
    small parts together, a large one to several files, unless they are ``arranged`` already.
    """
    spark = df.sparkSession
    numbered = df.withColumn(PART, part.cast("string"))
    numbered = numbered if arranged else numbered.hint("rebalance", PART)
    numbered.withColumn(RUN, F.lit(run).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, RUN).parquet(
        f"{path}/rows"
    )
    if parts is None:
        written = spark.read.schema(f"{PART} string, {RUN} long").parquet(f"{path}/rows")
        parts = written.where(F.col(RUN) == run)
    record = parts.select(F.col(PART).cast("string").alias(PART)).distinct().withColumn("replaces", F.lit(replaces))
    # a run that wrote nothing is committed, too
    empty = spark.createDataFrame([(None, None, None, None)], _COMMITS)
    record = record.unionByName(empty, allowMissingColumns=True)
    if notes is not None:
        record = record.unionByName(notes, allowMissingColumns=True)
    columns = [c.split()[0] for c in _COMMITS.split(", ")]
    record.select(columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{RUN}={run}")


def live(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(part, run) of the committed runs that readers see: a part's last replacing run and those after it."""
    known = commits(spark, path).where(F.col(PART).isNotNull())
    if before is not None:
        known = known.where(F.col(RUN) < before)
    base = F.max(F.when(F.col("replaces"), F.col(RUN))).over(Window.partitionBy(PART))
    return known.withColumn("_base", base).where(F.col("_base").isNull() | (F.col(RUN) >= F.col("_base"))).select(PART, RUN)


def read(
    spark: SparkSession, path: str, schema: T.StructType, where: Column | None = None, before: int | None = None
) -> DataFrame:
    """The rows, with ``part``, as of the commits (those of runs ``before`` a number).

    ``where`` is a condition on ``part``; it prunes folders, as do the commits.
    """
    stored = T.StructType([*schema.fields, T.StructField(PART, T.StringType()), T.StructField(RUN, T.LongType())])
    rows, seen = spark.read.schema(stored).parquet(f"{path}/rows"), live(spark, path, before)
    if where is not None:
        rows, seen = rows.where(where), seen.where(where)
    small = seen.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    return rows.join(F.broadcast(seen) if small else seen, [PART, RUN]).select(*schema.fieldNames(), PART)


def expire(spark: SparkSession, path: str, upto: int, most: int = 10_000) -> int:
    """Remove up to ``most`` folders that runs up to ``upto`` have replaced; the number removed.

    Call it when no reader is left that began before those runs. Commits stay; they are few rows.
    """
    known = commits(spark, path).where(F.col(PART).isNotNull() & (F.col(RUN) <= upto))
    base = F.max(F.when(F.col("replaces"), F.col(RUN))).over(Window.partitionBy(PART))
    old = known.withColumn("_base", base).where(F.col(RUN) < F.col("_base"))
    jvm, removed = spark._jvm, 0
    for row in old.select(PART, RUN).distinct().limit(most).collect():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/rows/{PART}={row[0]}/{RUN}={row[1]}")
        removed += folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    return removed
