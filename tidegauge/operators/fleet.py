"""The sensor fleet: what should report, what did, and how good the detector is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import BUCKET_ORIGIN, time_bucket, width_seconds
from ..session import write_through

# Fixed values of the fleet layout.
SENSOR_TYPES = ["temperature", "vibration", "pressure"]
SENSORS_PER_MACHINE = 10


def sensor_type(index: Column) -> Column:
    """Types rotate over the sensors of a machine."""
    types = F.array(*[F.lit(t) for t in SENSOR_TYPES])
    return F.element_at(types, (index % len(SENSOR_TYPES) + 1).cast("int"))


def sensor_id(machine: Column, index: Column) -> Column:
    return F.format_string("%s-s%02d-%s", machine, index, sensor_type(index))


def sensor_dimension(machines: DataFrame, per_machine: int = SENSORS_PER_MACHINE) -> DataFrame:
    """Every sensor of every machine. ``machines`` has a ``machine_id`` column of distinct values."""
    index = F.explode(F.sequence(F.lit(0), F.lit(per_machine - 1))).alias("sensor_index")
    listed = machines.select("machine_id", index)
    i = F.col("sensor_index")
    return listed.select(
        "machine_id",
        sensor_id(F.col("machine_id"), i).alias("sensor_id"),
        sensor_type(i).alias("sensor_type"),
        "sensor_index",
    )


def fleet_coverage(readings: DataFrame, dimension: DataFrame, width: str) -> DataFrame:
    """Sensors of the dimension that did not report in a bucket in which any sensor did.

    A sensor's buckets are bit sets, 64 buckets to a word, made in one scan of the readings. The words of all
    sensors give the buckets that count; what a sensor lacks of them is a word again, and only its bits
    become rows. The table of words is read where a join of sensors and buckets would be: 64 times fewer rows.
    """
    seconds, offset = width_seconds(width), int(BUCKET_ORIGIN.timestamp()) % width_seconds(width)
    number = F.floor((F.unix_seconds(time_bucket(width, F.col("event_time"))) - offset) / seconds).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_n").bitwiseAND(63).cast("int"))
    words = readings.select(number.alias("_n"), "sensor_id").groupBy("sensor_id", F.shiftright("_n", 6).alias("_word"))
    seen = write_through(words.agg(F.bit_or(bit).alias("_seen")), "coverage")
    ends = seen.agg(F.min("_word"), F.max("_word")).first()
    counted = seen.groupBy("_word").agg(F.bit_or("_seen").alias("_counts"))
    # the sensors are few rows before they are spread over time: share them out first
    tasks = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = F.array().cast("array<long>") if ends[0] is None else F.sequence(F.lit(ends[0]), F.lit(ends[1]))
    spread = dimension.repartition(tasks, "sensor_id").withColumn("_word", F.explode(span))
    both = spread.join(counted, "_word").join(seen, ["sensor_id", "_word"], "left")
    lacking = F.col("_counts").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0))))
    bits = F.filter(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("_lacking").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0,
    )
    missing = both.withColumn("_lacking", lacking).where("_lacking <> 0").withColumn("_bit", F.explode(bits))
    bucket = F.timestamp_seconds((F.col("_word") * 64 + F.col("_bit")) * seconds + offset)
    return missing.select(bucket.alias("bucket"), "machine_id", "sensor_id", "sensor_type")


def detector_quality(scored: DataFrame, by: str = "sensor_type") -> DataFrame:
    """Confusion counts, precision and recall of the detector against the injected label."""
    flagged, real = (F.coalesce(F.col(c), F.lit(False)) for c in ("is_anomaly", "anomaly_injected"))

    def counted(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).alias(name)

    counts = scored.groupBy(by).agg(
        counted(flagged & real, "tp"),
        counted(flagged & ~real, "fp"),
        counted(~flagged & real, "fn"),
        counted(~flagged & ~real, "tn"),
    )
    return counts.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn(
        "recall", F.try_divide("tp", F.col("tp") + F.col("fn"))
    )
