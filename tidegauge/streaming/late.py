"""Late routing on streams: a watermark per source, kept in a table and advanced batch by batch.

``withWatermark`` bounds state and drops what is behind it. Here no row is dropped: each micro-batch is split into
rows on time and late ones, and both go to a sink of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import is_late
from ..operators.blocks import null_safe_join
from ..operators.lateness import BROADCAST_ROWS, batch_watermarks
from ..sources import versions

Sink = Callable[[DataFrame, int], None]

_MARKS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("before_ms", T.LongType()),
        T.StructField("top_ms", T.LongType()),
    ]
)


def marks(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """One row per source: its last arrival batch, and the largest event times ahead of that batch and with it."""
    return versions.read(spark, path, _MARKS, before=before).drop(versions.PART)


def route_late(
    path: str, event_ms: str, allowed_ms: int, on_time: Sink, late: Sink, source: str | None = None, arrival: str | None = None
) -> Sink:
    """A ``foreachBatch`` function that splits rows by the watermark of their source.

    A row is late if it is older than the largest event time of all earlier arrival batches of its source by more
    than the grace period. Arrival batches are numbered by ``arrival`` (a number that does not fall from one
    micro-batch to the next; a smaller one counts as the last seen), or are the micro-batches. So the split does not
    depend on how the stream was cut into micro-batches. ``on_time`` and ``late`` are called with the batch id, which
    they must write under: a batch that is run again finds the marks as they were and gives both the same
    rows. The marks are one row per source, and are committed last.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions.create(spark, path, _MARKS)
        named = F.lit(None).cast("string") if source is None else F.col(source).cast("string")
        number = F.lit(batch_id) if arrival is None else F.col(arrival)
        seen = marks(spark, path, before=batch_id)
        small = seen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        rows = batch.withColumn("_source", named)
        rows = null_safe_join(rows, seen.select(F.col("source").alias("_source"), F.col("arrival").alias("_last")), ["_source"], "left", small)
        last = F.coalesce(F.greatest(number.cast("long"), F.col("_last")), number.cast("long"))
        rows = rows.withColumn("_arrival", last).drop("_last").persist(StorageLevel.MEMORY_AND_DISK)
        tops = rows.groupBy("_source", "_arrival").agg(F.max(event_ms).alias("_ms"))
        # what is known of earlier batches: the last one, and one before it that stands for all others
        known = seen.select(F.col("source").alias("_source"), F.col("arrival").alias("_arrival"), F.col("top_ms").alias("_ms"))
        older = seen.select(F.col("source").alias("_source"), (F.col("arrival") - 1).alias("_arrival"), F.col("before_ms").alias("_ms"))
        tops = tops.unionByName(known).unionByName(older).persist(StorageLevel.MEMORY_AND_DISK)
        found = batch_watermarks(tops, "_arrival", "_ms", ["_source"]).persist(StorageLevel.MEMORY_AND_DISK)
        few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        marked = null_safe_join(rows, found, ["_source", "_arrival"], "left", few)
        is_behind = is_late(F.col(event_ms), F.col("watermark_ms"), allowed_ms)
        marked = marked.withColumn("_late", is_behind)
        on_time(marked.where(~F.col("_late")).select(*batch.columns), batch_id)
        late(marked.where("_late").select(*batch.columns, "watermark_ms"), batch_id)
        ended = tops.groupBy("_source").agg(F.max("_arrival").alias("arrival"), F.max("_ms").alias("top_ms"))
        before = found.select("_source", F.col("_arrival").alias("arrival"), F.col("watermark_ms").alias("before_ms"))
        after = null_safe_join(ended, before, ["_source", "arrival"], "left")
        after = after.select(F.col("_source").alias("source"), "arrival", "before_ms", "top_ms")
        versions.publish(after, path, F.lit("marks"), batch_id, True)
        for kept in (found, tops, rows):
            kept.unpersist()

    return run


def append_to(path: str) -> Sink:
    """A sink that writes a batch under its id; a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
