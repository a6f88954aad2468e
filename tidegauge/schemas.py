"""Schemas of the wire records, the stored tables and the metric samples."""

from __future__ import annotations

from pyspark.sql import types as T

TICK_RECORD = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("event_time", T.LongType()),
    ]
)

SENSOR_RECORD = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("anomaly_injected", T.BooleanType()),
    ]
)

TICKS = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType()),
        T.StructField("zscore", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

SENSOR_READINGS = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("sensor_type", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("zscore", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

TICKS_1M = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("tick_count", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
    ]
)

SENSOR_READINGS_1M = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("avg_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("stddev_value", T.DoubleType()),
        T.StructField("reading_count", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
    ]
)

METRIC_SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("grp", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("log_end", T.LongType()),
        T.StructField("committed", T.LongType()),
    ]
)

LOAD_SAMPLES = T.StructType(
    [
        T.StructField("hz", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("events_per_s", T.DoubleType()),
        T.StructField("lag", T.DoubleType()),
        T.StructField("p99_s", T.DoubleType()),
    ]
)

DEAD_LETTERS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# Row shape of a keyed broker topic.
KEYED_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
