"""Stored rollups that follow their raw table: refreshed where rows came in, read with what is newer.

Whoever appends rows logs the hours they fall into. A refresh takes the log entries that no earlier refresh took,
recomputes the buckets of those hours and of the time since the last refresh out of the raw rows, and publishes the
dates they lie in, with the stored buckets of their other hours, as one run; its commit also says which entries it
took and how far it reached. Nothing is overwritten in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import width_seconds
from ..session import write_through
from . import versions

MAX_RANGES = 64  # time ranges that a refresh reads; beyond that the nearest ones are joined


@dataclass(frozen=True)
class RollupTable:
    """A rollup of buckets that divide an hour. ``make`` turns raw rows and a width into buckets."""

    path: str
    schema: T.StructType
    make: Callable[..., DataFrame]
    width: str = "1 minute"

    def __post_init__(self) -> None:
        if 3600 % width_seconds(self.width):
            raise ValueError("the width must divide an hour")


def create(spark: SparkSession, table: RollupTable) -> None:
    versions.create(spark, table.path, table.schema)
    spark.createDataFrame([], "hour timestamp").write.mode("ignore").parquet(f"{table.path}/touched")


def log_touched(rows: DataFrame, table: RollupTable, entry: str, time: str = "event_time") -> None:
    """Log the hours of appended rows under a name of the append's own. Append first, then log: a failure in
    between is mended by the repeat, which writes both again."""
    hours = rows.select(F.date_trunc("hour", time).alias("hour")).distinct()
    hours.coalesce(1).write.mode("overwrite").parquet(f"{table.path}/touched/entry={entry}")


def _date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _at(when: dt.datetime) -> Column:
    when = when if when.tzinfo else when.replace(tzinfo=dt.timezone.utc)
    return F.lit(when.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def reached(spark: SparkSession, table: RollupTable) -> dt.datetime | None:
    """How far the last refresh reached: buckets from there on are not stored."""
    upto = versions.commits(spark, table.path).agg(F.unix_micros(F.max("upto"))).first()[0]
    return None if upto is None else dt.datetime.fromtimestamp(upto / 1e6, dt.timezone.utc)


def ranges(hours: DataFrame, most: int = MAX_RANGES) -> list[tuple[dt.datetime, dt.datetime]]:
    """The hours as at most ``most`` ranges (first hour, last hour), cut at the widest gaps.

    ``hours`` has one row for each hour: as many as the time it spans has, whatever the number of events.
    """
    hours = hours.select(F.unix_seconds("hour").alias("_s"))
    gap = F.col("_s") - F.lag("_s").over(Window.orderBy("_s"))
    gaps = hours.withColumn("_gap", gap)
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("_gap"), "_s"))
    cut = F.when((F.col("_gap") > 3600) & (F.col("_rank") < most), 1).otherwise(0)
    group = F.sum(cut).over(Window.orderBy("_s"))
    found = gaps.withColumn("_rank", rank).withColumn("_group", group).groupBy("_group").agg(F.min("_s"), F.max("_s"))
    as_time = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc)
    return sorted((as_time(lo), as_time(hi)) for _, lo, hi in found.collect())


def _inside(time: str, spans: list[tuple[dt.datetime, dt.datetime]]) -> Column:
    hour = dt.timedelta(hours=1)
    return reduce(Column.__or__, [(F.col(time) >= _at(lo)) & (F.col(time) < _at(hi + hour)) for lo, hi in spans])


def between(raw: DataFrame, spans: list[tuple[dt.datetime, dt.datetime]], time: str = "event_time") -> DataFrame:
    """Rows of the hours in the ranges; a table laid out by ``event_date`` is pruned to their dates."""
    if "event_date" in raw.columns:
        dates = [F.col("event_date").between(F.to_date(_at(lo)), F.to_date(_at(hi))) for lo, hi in spans]
        raw = raw.where(reduce(Column.__or__, dates))
    return raw.where(_inside(time, spans))


def refresh(raw: DataFrame, table: RollupTable, run: int, now: dt.datetime, end_offset: str = "1 minute") -> int:
    """Recompute what was touched, as far as ``now`` less ``end_offset``; the number of hours recomputed.

    A run that is committed is not run again.
    """
    spark = raw.sparkSession
    if versions.committed(spark, table.path, run):
        return 0
    width, before = width_seconds(table.width), reached(spark, table)
    now = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    seconds = int((now - dt.timedelta(seconds=width_seconds(end_offset))).timestamp())
    upto = dt.datetime.fromtimestamp(seconds - seconds % width, dt.timezone.utc)
    upto = upto if before is None else max(upto, before)

    log = spark.read.schema("hour timestamp, entry string").parquet(f"{table.path}/touched")
    taken = versions.commits(spark, table.path).where("entry IS NOT NULL").select("entry").distinct()
    log = write_through(log.where("entry IS NOT NULL").join(taken, "entry", "left_anti"), "touched")
    hours = log.select("hour").distinct()
    if before is not None:
        # the hours since the last refresh were stored in part at most
        open_ = F.sequence(F.date_trunc("hour", _at(before)), F.date_trunc("hour", _at(upto)), F.expr("INTERVAL 1 HOUR"))
        hours = hours.union(spark.range(1).select(F.explode(open_).alias("hour"))).distinct()
    spans = ranges(hours.where(F.col("hour") < _at(upto)))
    notes = log.select("entry").distinct().withColumn("upto", F.lit(None).cast("timestamp"))
    notes = notes.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("entry"), _at(upto).alias("upto")))
    rows = between(raw, spans).where(F.col("event_time") < _at(upto)) if spans else raw.where(F.lit(False))
    made = table.make(rows, table.width).select(*table.schema.fieldNames())
    parts = spark.createDataFrame([], "part string")
    if spans:
        # dates whose rows are gone are replaced by nothing
        listed = [F.sequence(F.to_date(_at(lo)), F.to_date(_at(hi))) for lo, hi in spans]
        parts = spark.range(1).select(F.explode(F.concat(*listed)).alias("date")).select(_date(F.col("date")).alias("part"))
        dates = [F.col(versions.PART).between(_date(_at(lo)), _date(_at(hi))) for lo, hi in spans]
        old = versions.read(spark, table.path, table.schema, reduce(Column.__or__, dates)).drop(versions.PART)
        made = made.unionByName(old.where(~_inside("bucket", spans)))
    versions.publish(made, table.path, _date(F.col("bucket")), run, True, parts, notes)
    return sum(int((hi - lo).total_seconds()) // 3600 + 1 for lo, hi in spans)


def stored(spark: SparkSession, table: RollupTable, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored buckets with ``start <= bucket <= end``; only the dates of the range are read."""
    where = F.lit(True)
    if start is not None:
        where = where & (F.col(versions.PART) >= _date(F.lit(start).cast("timestamp")))
    if end is not None:
        where = where & (F.col(versions.PART) <= _date(F.lit(end).cast("timestamp")))
    return _within(versions.read(spark, table.path, table.schema, where), start, end).drop(versions.PART)


def _within(buckets: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        buckets = buckets.where(F.col("bucket") >= F.lit(start).cast("timestamp"))
    if end is not None:
        buckets = buckets.where(F.col("bucket") <= F.lit(end).cast("timestamp"))
    return buckets


def served(raw: DataFrame, table: RollupTable, start: str | None = None, end: str | None = None) -> DataFrame:
    """Buckets with ``start <= bucket <= end``: the stored ones, and from where the last refresh ended on the
    buckets of the raw rows. Both sides read their part of the range only."""
    spark = raw.sparkSession
    upto = reached(spark, table)
    time, dated = F.col("event_time"), "event_date" in raw.columns
    lows = [] if upto is None else [_at(upto)]
    if start is not None:
        lows.append(F.lit(start).cast("timestamp"))
    tail = raw
    if lows:
        low = F.greatest(*lows) if len(lows) > 1 else lows[0]
        tail = tail.where(time >= low)
        tail = tail.where(F.col("event_date") >= F.to_date(low)) if dated else tail
    if end is not None:
        # the last bucket of the range is read to its end
        high = F.lit(end).cast("timestamp") + F.expr(f"INTERVAL {width_seconds(table.width)} SECONDS")
        tail = tail.where(time < high)
        tail = tail.where(F.col("event_date") <= F.to_date(high)) if dated else tail
    fresh = _within(table.make(tail, table.width), start, end).select(*table.schema.fieldNames())
    if upto is None:
        return fresh
    return stored(spark, table, start, end).where(F.col("bucket") < _at(upto)).unionByName(fresh)
