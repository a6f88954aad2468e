"""The event table seen as ticks, sensor readings, arrivals, raw lines and pipeline metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.payload import compute_once
from ..functions.times import to_event_ts
from ..operators import health
from ..operators.fleet import SENSORS_PER_MACHINE, sensor_id, sensor_type

# Bounds of the write-time histogram, in seconds.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

# Load stage each event type stands for.
STAGES = {"click": 5, "view": 10, "signup": 25, "purchase": 50, "error": 100}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table.withColumn("ms", ms).withColumn("event_time", to_event_ts(F.col("ms")))


def _volume() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_columns(events(spark, sf_dir))


def tick_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").alias("seq"),
        "event_time",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _volume().alias("volume"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_columns(events(spark, sf_dir))


def sensor_columns(df: DataFrame) -> DataFrame:
    machine, sensor, kind = sensor_names()
    return df.select(
        F.col("event_id").alias("seq"),
        "event_time",
        machine.alias("machine_id"),
        sensor.alias("sensor_id"),
        kind.alias("sensor_type"),
        "value",
        (F.col("value") >= 200).alias("anomaly_injected"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an arrival up to 96 minutes after the event, in hourly batches."""
    delay = (F.col("event_id") * 7919 % 97) * 60000
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        "ms",
        (F.col("ms") + delay).alias("arrival"),
        F.expr("(ms + (event_id * 7919 % 97) * 60000) div 3600000").alias("batch"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
    )


# Raw lines: every fault the parsers know, spread over the events by id. Plain SQL text, so that the
# same lines can be made elsewhere.
_PRICE = "CAST(CAST(value AS DECIMAL(18,2)) AS {text})"
TICK_LINE = """
  CASE event_id % 20
    WHEN 0 THEN concat('{"symbol":"', event_type, '","price":"', p, '","event_time":"', ms, '"}')
    WHEN 1 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, ',"volume":null}')
    WHEN 2 THEN concat('{"symbol":"', event_type, '","price":"x","event_time":', ms, '}')
    WHEN 3 THEN concat('{"symbol":"', event_type, '","price":', p, '}')
    WHEN 4 THEN concat('{"symbol":null,"price":', p, ',"event_time":', ms, '}')
    WHEN 5 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '} x')
    WHEN 6 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '.9,"volume":"2.5"}')
    WHEN 7 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":"1.9"}')
    WHEN 8 THEN concat('[', p, ']')
    WHEN 9 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '}')
    WHEN 10 THEN concat('{"symbol":"', event_type, '","price":"Infinity","event_time":', ms, '}')
    WHEN 11 THEN concat('{"symbol":{"a":1},"price":', p, ',"event_time":', ms, '}')
    WHEN 12 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms)
    WHEN 13 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, ',"volume":"q"}')
    WHEN 14 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '},"x":1')
    WHEN 15 THEN concat('1,"v":{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '}')
    WHEN 16 THEN concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, '},{}')
    ELSE concat('{"symbol":"', event_type, '","price":', p, ',"event_time":', ms, ',"volume":', k, '}')
  END"""
SENSOR_LINE = """
  CASE event_id % 16
    WHEN 0 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":"', p, '","event_time":', ms, '}')
    WHEN 1 THEN concat('{"sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":', p, ',"event_time":', ms, '}')
    WHEN 2 THEN concat('{"machine_id":"', machine_id, '","sensor_id":7,"sensor_type":"', sensor_type, '","value":', p, ',"event_time":', ms, '}')
    WHEN 3 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":null,"value":', p, ',"event_time":', ms, '}')
    WHEN 4 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":null,"event_time":', ms, '}')
    WHEN 5 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":"nan","event_time":', ms, '}')
    WHEN 6 THEN concat('machine ', machine_id, ' is down')
    WHEN 7 THEN 'null'
    WHEN 8 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":', p, ',"event_time":', ms, '},"x":1')
    WHEN 9 THEN concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":', p, ',"event_time":', ms, '}]')
    ELSE concat('{"machine_id":"', machine_id, '","sensor_id":"', sensor_id, '","sensor_type":"', sensor_type, '","value":', p, ',"event_time":', ms, ',"anomaly_injected":', lower(CAST(value >= 200 AS {text})), '}')
  END"""
FRAME_LINE = """
  CASE event_id % 12
    WHEN 0 THEN '{"type":"ping"}'
    WHEN 1 THEN '{"type":"trade"}'
    WHEN 2 THEN '{"type":"trade","data":null}'
    WHEN 3 THEN concat('{"type":"trade","data":{"p":', p, '}}')
    WHEN 4 THEN concat('{"type":"trade","data":[{"s":"', event_type, '","p":', p, ',"t":', ms, ',"v":', k, '},{"s":"', event_type, '","p":"x","t":', ms, '},"junk",{"s":"', event_type, '","p":', p, ',"t":', ms, ',"v":null}]}')
    WHEN 5 THEN concat('{"type":"trade","data":[{"p":', p, ',"t":', ms, '},{"s":"', event_type, '","p":"', p, '","t":"', ms, '"}]}')
    WHEN 6 THEN concat('[', ms, ']')
    WHEN 7 THEN concat('{"type":"trade","data":[', p)
    WHEN 8 THEN concat('{"type":"trade","data":[{"s":"', event_type, '","p":', p, ',"t":', ms, '}]},"x":1')
    ELSE concat('{"type":"trade","data":[{"s":"', event_type, '","p":', p, ',"t":', ms, ',"v":', k, '},{"s":"', event_type, '","p":', k, ',"t":', ms, '}]}')
  END"""


def lines_of(df: DataFrame, line: str) -> DataFrame:
    parts = df.withColumn("p", F.expr(_PRICE.replace("{text}", "STRING"))).withColumn(
        "k", F.get_json_object("props", "$.k")
    )
    made = compute_once(parts, raw=F.expr(line.replace("{text}", "STRING")))
    return made.select(F.col("event_id").alias("seq"), "raw")


def tick_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(events(spark, sf_dir), TICK_LINE)


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dict(zip(["machine_id", "sensor_id", "sensor_type"], sensor_names()))
    return lines_of(events(spark, sf_dir).withColumns(names), SENSOR_LINE)


def sensor_names() -> list[Column]:
    machine = F.format_string("machine-%02d", F.col("user_id") % 5 + 1)
    index = F.expr("user_id div 5") % SENSORS_PER_MACHINE
    return [machine, sensor_id(machine, index), sensor_type(index)]


def frame_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(events(spark, sf_dir), FRAME_LINE)


# ---- pipeline metrics ----


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two event counters sampled at each event; they start again from one now and then."""
    base = events(spark, sf_dir)
    cycles = F.explode(
        F.array(
            F.struct(F.lit("ticks").alias("stream"), F.lit(3000).alias("cycle")),
            F.struct(F.lit("sensors").alias("stream"), F.lit(7000).alias("cycle")),
        )
    )
    spread = base.select("event_id", "event_time", cycles.alias("c"))
    return spread.select(
        F.col("event_id").alias("seq"),
        F.col("event_time").alias("ts"),
        F.lit("events_total").alias("name"),
        F.create_map(F.lit("stream"), F.col("c.stream")).alias("labels"),
        F.col("c.stream").alias("stream"),
        (F.col("event_id") % F.col("c.cycle") + 1).cast("double").alias("value"),
    )


def latency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write times by table as cumulative buckets; an event's value is its milliseconds."""
    timed = events(spark, sf_dir).select(
        F.col("event_type").alias("table"), (F.col("value") / 1000).alias("seconds")
    )
    return health.cumulative_buckets(timed, "seconds", LATENCY_BOUNDS, ["table"])


def latency_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets of ``latency_buckets`` as counters, sampled once a minute; they restart every six hours."""
    base = events(spark, sf_dir)
    timed = base.select(
        F.col("event_type").alias("table"), (F.col("value") / 1000).alias("seconds"), F.expr("ms div 60000").alias("minute"), "ms"
    )
    counted = health.cumulative_buckets(timed, "seconds", LATENCY_BOUNDS, ["table", "minute"])
    ends = timed.groupBy("table", "minute").agg(F.timestamp_millis(F.max("ms")).alias("ts"))
    so_far = Window.partitionBy("table", "le", F.expr("minute div 360")).orderBy("minute")
    sampled = counted.withColumn("value", F.sum("value").over(so_far)).join(ends, ["table", "minute"])
    return sampled.select("table", "le", "ts", "value")


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log end and commit per partition: two groups read five partitions each, small values first."""
    base = events(spark, sf_dir)
    return base.groupBy(
        F.when(F.col("user_id") % 2 == 0, "scorer").otherwise("archiver").alias("grp"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 5).cast("int").alias("partition"),
    ).agg(
        (F.max("event_id") + 1).alias("log_end"),
        F.coalesce(F.max(F.when(F.col("value") < 20, F.col("event_id"))) + 1, F.lit(0)).alias("committed"),
    )


def load_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    hz = F.lit(None).cast("int")
    for kind, rate in STAGES.items():
        hz = F.when(F.col("event_type") == kind, F.lit(rate)).otherwise(hz)
    return events(spark, sf_dir).select(
        hz.alias("hz"),
        F.col("event_time").alias("ts"),
        F.col("value").alias("events_per_s"),
        F.col("user_id").cast("double").alias("lag"),
        (_volume() / 1000).alias("p99_s"),
    )


def load_starts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("hz").agg(F.min_by("lag", F.struct("ts", "lag")).alias("start_lag"))
