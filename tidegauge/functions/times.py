"""Event-time and series expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Buckets of widths that do not divide a day are counted from this Monday.
BUCKET_ORIGIN = dt.datetime(2000, 1, 3, tzinfo=dt.timezone.utc)

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def width_seconds(width: str) -> int:
    """Seconds of an interval text such as ``"5 minutes"``."""
    total = 0
    words = width.split()
    if len(words) % 2:
        raise ValueError(f"not an interval: {width!r}")
    for count, unit in zip(words[::2], words[1::2]):
        total += int(count) * _UNIT_SECONDS[unit.lower().rstrip("s")]
    return total


def to_event_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def _start_offset(width: str, origin: dt.datetime) -> str:
    return f"{int(origin.timestamp()) % width_seconds(width)} seconds"


def time_window(
    ts: Column, width: str, slide: str | None = None, origin: dt.datetime = BUCKET_ORIGIN
) -> Column:
    """Tumbling window, or hopping when ``slide`` is given."""
    return F.window(ts, width, slide or width, _start_offset(slide or width, origin))


def time_bucket(width: str, ts: Column, origin: dt.datetime = BUCKET_ORIGIN) -> Column:
    """Start of the bucket that holds ``ts``."""
    return time_window(ts, width, origin=origin)["start"]


def time_filter(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Rows with ``start <= column <= end``; a bound that is None is open.

    A table laid out by ``event_date`` also gets the date range, so that files are pruned.
    """
    dated = "event_date" in df.columns
    if start is not None:
        lo = F.lit(start).cast("timestamp")
        df = df.where(F.col(column) >= lo)
        df = df.where(F.col("event_date") >= F.to_date(lo)) if dated else df
    if end is not None:
        hi = F.lit(end).cast("timestamp")
        df = df.where(F.col(column) <= hi)
        df = df.where(F.col("event_date") <= F.to_date(hi)) if dated else df
    return df


def as_series(df: DataFrame, time: str, metric: Column, value: str) -> DataFrame:
    """Long form ``(time, metric, value)``."""
    return df.select(F.col(time).alias("time"), metric.alias("metric"), F.col(value).alias("value"))


def machine_label(machine: str = "machine_id", kind: str = "sensor_type") -> Column:
    return F.concat(F.col(machine), F.lit("/"), F.col(kind))


def flag_bit(flag: str = "is_anomaly") -> Column:
    return F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))


def wide_series(series: DataFrame, metrics: list[str]) -> DataFrame:
    """One column per metric. Naming the metrics saves the job that would look for them.

    Where a metric has several values at one time, the largest is shown.
    """
    return series.groupBy("time").pivot("metric", metrics).agg(F.max("value"))
