"""Start and stop streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.rollup import merge_parts, summarise
from ..sources import versions

FLUSH_SECONDS = 1.0  # fixed value: longest time a row waits before it is written


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    flush_seconds: float | None = FLUSH_SECONDS,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run ``write`` on each micro-batch; ``flush_seconds=None`` works off what is there and ends.

    The size half of the flush policy is the source's limit per trigger.
    """
    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if flush_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{flush_seconds} seconds").start()


def drain(query: StreamingQuery) -> None:
    """Write out what has arrived, then stop."""
    query.processAllAvailable()
    query.stop()


def with_counters(stream: DataFrame, name: str) -> DataFrame:
    """Count events and anomalies of a scored stream into its progress reports."""
    return stream.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomalies"),
    )


def fold_rollup(path: str, keys: Sequence[str], value: str, width: str = "1 minute") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a rollup of a stream as summaries of its buckets, one part per batch.

    A batch adds the summaries of its own rows, however late they are: nothing waits for a watermark and nothing is
    dropped behind one. A batch that is run again finds its commit.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions.create(spark, path, summary_schema(batch, keys))
        if versions.committed(spark, path, 2 * batch_id):
            return
        made = summarise(batch, keys, value, width)
        versions.publish(made, path, F.to_date("bucket"), 2 * batch_id)

    return run


def summary_schema(rows: DataFrame, keys: Sequence[str]) -> T.StructType:
    """Of the parts that ``fold_rollup`` keeps."""
    numbers = [("n", T.LongType()), *[(c, T.DoubleType()) for c in ("mean", "m2", "lo", "hi")], ("rows", T.LongType()), ("flagged", T.LongType())]
    fields = [T.StructField("bucket", T.TimestampType()), *[rows.schema[k] for k in keys]]
    return T.StructType([*fields, *[T.StructField(n, t) for n, t in numbers]])


def folded(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """The summaries of all committed batches, merged; ``where`` is a condition on the date (``part``)."""
    return merge_parts(versions.read(spark, path, schema, where).drop(versions.PART), ["bucket", *keys])


def compact_rollup(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], last_batch: int) -> None:
    """Merge the parts of all batches up to ``last_batch`` into one part per date.

    Its run lies between those of this batch and the next, so that later batches are not replaced.
    """
    run = 2 * last_batch + 1
    if not versions.committed(spark, path, run):
        parts = versions.read(spark, path, schema, before=run).drop(versions.PART)
        versions.publish(merge_parts(parts, ["bucket", *keys]), path, F.to_date("bucket"), run, True)
