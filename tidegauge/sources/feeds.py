"""Event feeds in, keyed records and dead letters out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEYED_RECORD
from . import versions

TOPIC_PARTITIONS = 5  # fixed value: partitions of a feed


def read_events_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "kafka",
    starting: str = "latest",
    per_trigger: int | None = None,
    flush_rows: int | None = None,
    flush_seconds: float = 1.0,
    **options: str,
) -> DataFrame:
    """Stream of keyed records with ``raw`` text.

    ``kafka``: ``source`` is the topic and ``kafka.bootstrap.servers`` an option; needs the Kafka
    connector on the classpath. ``parquet`` / ``json``: a folder of keyed records as written by
    ``write_keyed``. ``text``: a folder of plain lines. ``per_trigger`` limits a micro-batch (offsets
    or files), so that a backlog shows as lag and not as one giant batch. ``flush_rows`` (Kafka only)
    makes a micro-batch of so many records, or of what has come after ``flush_seconds``, whichever is first.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("subscribe", source).option("startingOffsets", starting)
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        if flush_rows:
            delay = f"{round(flush_seconds * 1000)}ms"
            reader = reader.option("minOffsetsPerTrigger", flush_rows).option("maxTriggerDelay", delay)
        records = reader.load()
        return records.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("raw"),
            "partition",
            "offset",
            "timestamp",
        )
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if fmt == "text":
        return reader.load(source).withColumnRenamed("value", "raw")
    return reader.schema(KEYED_RECORD).load(source).withColumnRenamed("value", "raw")


def read_trade_frames(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Vendor frames, one per line, as ``raw``."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").load(path).withColumnRenamed("value", "raw")


def keyed_records(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """``(key, value)`` with the record as JSON text."""
    fields = columns or df.columns
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def partition_of(key: Column, partitions: int = TOPIC_PARTITIONS) -> Column:
    """The partition that holds all records of a key."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def write_keyed(
    df: DataFrame,
    key: str,
    path: str,
    offset: str,
    timestamp: Column,
    columns: list[str] | None = None,
    partitions: int = TOPIC_PARTITIONS,
) -> None:
    """Append records to a folder laid out like a topic.

    The order within a key is carried by ``offset`` and not by the files, so a key with many records
    is written by many tasks and nothing is shuffled.
    """
    fields = columns or df.columns
    df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        partition_of(F.col(key).cast("string"), partitions).alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        timestamp.alias("timestamp"),
    ).write.mode("append").parquet(path)


KEYED_ROWS = T.StructType([f for f in KEYED_RECORD.fields if f.name in ("key", "value", "offset", "timestamp")])


def write_keyed_batch(
    df: DataFrame,
    key: str,
    path: str,
    offset: str,
    timestamp: Column,
    batch_id: int,
    columns: list[str] | None = None,
    partitions: int = TOPIC_PARTITIONS,
) -> bool:
    """Add one batch's records exactly once; whether they were new.

    The commit of a batch is its last write: a batch that failed before is written again in place of what it
    left, one that is delivered again finds its commit and adds nothing. Read them with ``read_keyed``.
    """
    spark = df.sparkSession
    versions.create(spark, path, KEYED_ROWS)
    if versions.committed(spark, path, batch_id):
        return False
    name = F.col(key).cast("string")
    records = df.select(
        name.alias("key"),
        F.to_json(F.struct(*(columns or df.columns))).alias("value"),
        F.col(offset).cast("long").alias("offset"),
        timestamp.alias("timestamp"),
    )
    versions.publish(records, path, partition_of(F.col("key"), partitions), batch_id)
    return True


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The records of all committed batches; ``partition`` as in a topic."""
    rows = versions.read(spark, path, KEYED_ROWS)
    return rows.withColumn("partition", F.col(versions.PART).cast("int")).drop(versions.PART)


def publish_keyed(df: DataFrame, key: str, topic: str, servers: str, columns: list[str] | None = None):
    """Append records to a Kafka topic; needs the Kafka connector on the classpath."""
    writer = keyed_records(df, key, columns).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def dead_letters(rejected: DataFrame, source: str, ingest_ts: Column) -> DataFrame:
    """The rejected text as it came, with where it came from and why it was set aside."""
    return rejected.select(
        F.lit(source).alias("source"), "raw", "reason", ingest_ts.alias("ingest_ts")
    )


def write_dead_letters(rejected: DataFrame, source: str, ingest_ts: Column, batch_id: int, path: str) -> None:
    """Write one batch's dead letters; running the batch again replaces them."""
    dead_letters(rejected, source, ingest_ts).write.mode("overwrite").parquet(
        f"{path}/source={source}/batch_id={batch_id}"
    )


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, batch_id long, raw string, reason string, ingest_ts timestamp").parquet(path)
