"""Route rows that arrive after the watermark has passed them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import is_late
from ..session import write_through
from .blocks import null_safe_join

BROADCAST_ROWS = 1_000_000
_GROUP = 1024


def batch_watermarks(df: DataFrame, batch: str, event_ms: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, batch, watermark_ms)``: the largest event time of all earlier batches, NULL for the first.

    One row per batch (of each source in ``by``). The running maximum is taken within groups of
    batches and then over the groups, so that no single task sees them all.
    """
    by = list(by)
    tops = df.groupBy(*by, batch).agg(F.max(event_ms).alias("_top"))
    tops = tops.withColumn("_group", F.expr(f"`{batch}` div {_GROUP}"))
    groups = tops.groupBy(*by, "_group").agg(F.max("_top").alias("_top"))
    earlier = Window.partitionBy(*by).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*by, "_group", F.max("_top").over(earlier).alias("_before"))
    within = Window.partitionBy(*by, "_group").orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    marked = null_safe_join(tops.withColumn("_inside", F.max("_top").over(within)), groups, [*by, "_group"], "inner")
    return marked.select(*by, batch, F.greatest("_before", "_inside").alias("watermark_ms"))


def mark_late(
    df: DataFrame, batch: str, event_ms: str, allowed_ms: int, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``late``: older than the batch's watermark by more than the grace period."""
    marks = write_through(batch_watermarks(df, batch, event_ms), "watermarks")
    # beyond the limit the join shuffles, and adaptive execution splits a batch of many rows
    side = F.broadcast(marks) if marks.count() <= broadcast_rows else marks
    marked = df.join(side, batch, "left")
    late = is_late(F.col(event_ms), F.col("watermark_ms"), allowed_ms)
    return marked.withColumn("late", late).select(*df.columns, "watermark_ms", "late")


def split_late(
    df: DataFrame, batch: str, event_ms: str, allowed_ms: int, **options
) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)``."""
    marked = mark_late(df, batch, event_ms, allowed_ms, **options)
    return (
        marked.where(~F.col("late")).select(*df.columns),
        marked.where("late").select(*df.columns, "watermark_ms"),
    )
