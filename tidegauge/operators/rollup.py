"""Per-bucket rollups, mergeable summaries of buckets, and rollup tables refreshed by range."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import summary_of
from ..functions.times import flag_bit, time_bucket, time_window, width_seconds
from ..sources import versions

PARTITION = versions.PART


def tick_measures() -> list[Column]:
    return [
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.count(F.lit(1)).alias("tick_count"),
        F.sum(flag_bit()).alias("anomaly_count"),
    ]


def sensor_measures() -> list[Column]:
    return [
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.stddev_samp("value").alias("stddev_value"),
        F.count(F.lit(1)).alias("reading_count"),
        F.sum(flag_bit()).alias("anomaly_count"),
    ]


def summarise(df: DataFrame, keys: Sequence[str], value: str, width: str = "1 minute") -> DataFrame:
    """What a bucket's rows come to, in a form that parts can be merged in: count, mean, m2, extremes and flags."""
    grouped = df.groupBy(time_bucket(width, F.col("event_time")).alias("bucket"), *keys).agg(
        summary_of(F.col(value)).alias("_s"), F.count(F.lit(1)).alias("rows"), F.sum(flag_bit()).alias("flagged")
    )
    return grouped.select("bucket", *keys, "_s.*", "rows", "flagged")


def merge_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summaries of the same ``by``, merged: the spread of each part and that of the parts' means around the common one.

    One shuffle, of summaries; a group has one row for each part.
    """
    same = Window.partitionBy(*by)
    weighed = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(same), F.sum("n").over(same))
    gap = F.col("mean") - F.col("_mean")
    # equal values have a mean of their own value and no spread, to the last bit
    centred = parts.withColumn("_mean", F.coalesce(weighed, F.lit(0.0)))
    merged = centred.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("rows").alias("rows"),
        F.sum("flagged").alias("flagged"),
    )
    flat = F.col("lo") == F.col("hi")
    return merged.withColumn("mean", F.when(flat, F.col("lo")).otherwise(F.col("mean"))).withColumn(
        "m2", F.when(flat, F.lit(0.0)).otherwise(F.col("m2"))
    )


def tick_buckets(summaries: DataFrame) -> DataFrame:
    """Merged summaries as ``rollup_ticks`` gives them."""
    some = F.col("n") > 0
    return summaries.select(
        "bucket",
        "symbol",
        F.when(some, F.col("mean")).alias("avg_price"),
        F.col("hi").alias("max_price"),
        F.col("lo").alias("min_price"),
        F.col("rows").alias("tick_count"),
        F.col("flagged").alias("anomaly_count"),
    )


def sensor_buckets(summaries: DataFrame) -> DataFrame:
    """Merged summaries as ``rollup_sensors`` gives them."""
    n = F.col("n")
    return summaries.select(
        "bucket",
        "machine_id",
        "sensor_type",
        F.when(n > 0, F.col("mean")).alias("avg_value"),
        F.col("hi").alias("max_value"),
        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("stddev_value"),
        F.col("rows").alias("reading_count"),
        F.col("flagged").alias("anomaly_count"),
    )


def hopping(df: DataFrame, keys: Sequence[str], value: str, width: str, slide: str) -> DataFrame:
    """Summaries of overlapping windows, merged from panes of one slide: a row is aggregated once, whatever the overlap."""
    if width_seconds(width) % width_seconds(slide):
        raise ValueError("the window width must be a multiple of the slide")
    panes = summarise(df, keys, value, slide)
    step = F.expr(f"INTERVAL {width_seconds(slide)} SECONDS")
    first = F.col("bucket") - F.expr(f"INTERVAL {width_seconds(width) - width_seconds(slide)} SECONDS")
    starts = F.explode(F.sequence(first, F.col("bucket"), step)).alias("bucket")
    return merge_parts(panes.select(starts, *[c for c in panes.columns if c != "bucket"]), ["bucket", *keys])


def _rollup(df, keys, measures, width, slide):
    bucket = time_window(F.col("event_time"), width, slide)
    grouped = df.groupBy(bucket.alias("_w"), *keys).agg(*measures)
    return grouped.withColumn("bucket", F.col("_w")["start"]).select(
        "bucket", *[c for c in grouped.columns if c != "_w"]
    )


def rollup_ticks(df: DataFrame, width: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Price statistics by bucket and symbol; hopping windows when ``slide`` is given."""
    if slide is not None and width_seconds(width) % width_seconds(slide) == 0:
        return tick_buckets(hopping(df, ["symbol"], "price", width, slide))
    return _rollup(df, ["symbol"], tick_measures(), width, slide)


def rollup_sensors(df: DataFrame, width: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Reading statistics by bucket, machine and sensor type, pooling sensors of one type."""
    if slide is not None and width_seconds(width) % width_seconds(slide) == 0:
        return sensor_buckets(hopping(df, ["machine_id", "sensor_type"], "value", width, slide))
    return _rollup(df, ["machine_id", "sensor_type"], sensor_measures(), width, slide)


def read_rollup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rollup; its date column stays available for pruning."""
    return versions.read(spark, path, schema)


def rollup_between(spark, path, schema, start: str, end: str) -> DataFrame:
    """Buckets with ``start <= bucket <= end``, reading only the dates in that range."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    table = versions.read(spark, path, schema, F.col(PARTITION).between(_date(lo), _date(hi)))
    return table.where(F.col("bucket").between(lo, hi)).drop(PARTITION)


def _date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _at(when: dt.datetime) -> Column:
    return F.lit(when.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def create_rollup(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty rollup table."""
    versions.create(spark, path, schema)


def refresh_rollup(
    raw: DataFrame,
    rollup,
    path: str,
    schema: T.StructType,
    now: dt.datetime,
    width: str = "1 minute",
    start_offset: str = "10 minutes",
    end_offset: str = "1 minute",
    full: bool = False,
) -> None:
    """Recompute the whole buckets inside ``[now - start_offset, now - end_offset)``.

    Buckets outside the range keep their rows; ``full`` starts the range at the first event.
    ``rollup`` is ``rollup_ticks`` or ``rollup_sensors``. The touched dates are written as a new run,
    next to what readers still see, and running it again gives the same table. ``sources.rollups``
    refreshes what came in instead, however old.
    """
    spark = raw.sparkSession
    seconds = dt.timedelta(seconds=1)
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    hi = now - width_seconds(end_offset) * seconds
    span = F.col("event_time") < _at(hi)
    in_range = F.col("_end") <= _at(hi)
    touched = F.lit(True)
    if not full:
        lo = now - width_seconds(start_offset) * seconds
        # the bucket that holds the start of the range is only partly inside: it is left out below
        span = span & (F.col("event_time") >= _at(lo))
        in_range = in_range & (F.col("bucket") >= _at(lo))
        touched = F.col(PARTITION).between(_date(_at(lo)), _date(_at(hi)))
    if "event_date" in raw.columns:
        span = span & (F.col("event_date") <= F.to_date(_at(hi)))
        if not full:
            span = span & (F.col("event_date") >= F.to_date(_at(lo)))

    ends = F.col("bucket") + F.expr(f"INTERVAL {width_seconds(width)} SECONDS")
    names = schema.fieldNames()
    fresh = rollup(raw.where(span), width).withColumn("_end", ends).where(in_range).select(*names)
    old = versions.read(spark, path, schema, touched).withColumn("_end", ends)
    kept = old.where(~in_range).select(*names)
    run = versions.commits(spark, path).agg(F.coalesce(F.max(versions.RUN) + 1, F.lit(0))).first()[0]
    made = kept.unionByName(fresh)
    parts = made.select(_date(F.col("bucket")).alias(PARTITION)).unionByName(old.select(PARTITION))
    versions.publish(made, path, _date(F.col("bucket")), run, True, parts)
