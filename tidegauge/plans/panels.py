"""The dashboard queries. ``start`` and ``end`` are inclusive, both None for all rows; rollups and scored tables are given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import as_series, machine_label, time_filter
from ..operators import health

RECENT = 100  # fixed value: rows of a table panel


def _series(rollup, metric, value, start, end):
    return as_series(time_filter(rollup, "bucket", start, end), "bucket", metric, value).orderBy("time")


def live_price(ticks_1m: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return _series(ticks_1m, F.col("symbol"), "avg_price", start, end)


def tick_throughput(ticks_1m: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return _series(ticks_1m, F.col("symbol"), "tick_count", start, end)


def sensor_averages(readings_1m: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return _series(readings_1m, machine_label(), "avg_value", start, end)


def machine_anomalies(readings_1m: DataFrame, start: str | None, end: str | None, summed: bool = False) -> DataFrame:
    """Anomaly count per machine: a row per sensor type under the machine's label, or their sum."""
    series = _series(readings_1m, F.col("machine_id"), "anomaly_count", start, end)
    if not summed:
        return series
    return series.groupBy("time", "metric").agg(F.sum("value").alias("value")).orderBy("time")


def recent_anomalies(
    scored: DataFrame, columns: list[str], ties: list[str], start: str | None, end: str | None, limit: int = RECENT
) -> DataFrame:
    """The latest flagged rows in the range; ``ties`` settles the order within an instant."""
    flagged = time_filter(scored.where("is_anomaly"), "event_time", start, end)
    latest = flagged.orderBy(F.desc("event_time"), *ties).limit(limit)
    return latest.select(F.col("event_time").alias("time"), *columns)


def price_anomalies(scored_ticks: DataFrame, start: str | None, end: str | None, limit: int = RECENT) -> DataFrame:
    columns = ["symbol", "price", "zscore"]
    return recent_anomalies(scored_ticks, columns, _ties(scored_ticks, ["symbol"]), start, end, limit)


def sensor_anomalies(scored_sensors: DataFrame, start: str | None, end: str | None, limit: int = RECENT) -> DataFrame:
    columns = ["machine_id", "sensor_id", "sensor_type", "value", "zscore"]
    return recent_anomalies(scored_sensors, columns, _ties(scored_sensors, ["sensor_id"]), start, end, limit)


def _ties(df: DataFrame, keys: list[str]) -> list[str]:
    return [*keys, "seq"] if "seq" in df.columns else keys


def events_per_second(streams: DataFrame, width: str = "1 minute", slide: str | None = None) -> DataFrame:
    """``streams`` has ``event_time`` and the name of the ``stream``."""
    return health.event_rate(streams, ["stream"], width, slide)


def anomalies_per_second(streams: DataFrame, width: str = "1 minute", slide: str | None = None) -> DataFrame:
    return health.event_rate(streams, ["stream"], width, slide, flag="is_anomaly")


def lag_by_group(offsets: DataFrame) -> DataFrame:
    return health.consumer_lag(offsets, ["grp"])


def write_latency_p99(buckets: DataFrame, table: str = "table") -> DataFrame:
    return health.histogram_quantile(buckets, 0.99, [table])


def write_latency_p99_by_window(samples: DataFrame, width: str = "1 minute", step: str = "15 seconds", table: str = "table") -> DataFrame:
    """``(time, table, quantile)`` from samples of cumulative buckets (``ts``, ``le``, ``value``)."""
    found = health.trailing_quantile(samples, 0.99, [table], width, step)
    return found.withColumnRenamed("at", "time")


def dead_lettered(rejected: dict[str, DataFrame]) -> DataFrame:
    return health.stream_counters({}, rejected).select("stream", "dead_letters")
