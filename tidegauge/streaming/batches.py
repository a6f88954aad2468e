"""Score micro-batches with the batch operators, carrying each key's open baseline in a table.

No key is confined to a task: a key with many rows in the batch is split into blocks like in a
batch job, and its first rows go on from the stored summary. The table of summaries is dealt into
hash buckets of the keys; a batch reads and rewrites the buckets of its own keys only, as a run
committed last, so its cost follows its rows and the size of their buckets, not the keys it has not seen.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import stats
from ..functions.stats import BASELINE_ROWS, Z_THRESHOLD
from ..functions.times import to_event_ts
from ..operators import validate
from ..operators.blocks import BLOCK, OWN, POS, null_safe_join, ordered_blocks
from ..operators.scoring import EPOCH, score_sliding
from ..schemas import METRIC_SAMPLES
from ..sources import versions
from ..sources.feeds import write_dead_letters
from ..sources.tables import append_scored

STATE_BROADCAST_ROWS = 1_000_000
STATE_BUCKETS = 64  # hash buckets of the keys; a table keeps the number it was begun with
_MOMENTS = ("n", "mean", "m2", "lo", "hi")


def summary_state(batch: DataFrame, keys: Sequence[str]) -> T.StructType:
    """A key and the summary of its open epoch."""
    counts = [T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in _MOMENTS[1:]]]
    return T.StructType([*[batch.schema[k] for k in keys], *counts])


def empty_state(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.sparkSession.createDataFrame([], summary_state(batch, keys))


def bucket_of(keys: Sequence[str], buckets: int = STATE_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def stored_state(
    batch: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], batch_id: int, buckets: int = STATE_BUCKETS
) -> tuple[DataFrame, list[str]]:
    """The state of the keys in the buckets that ``batch`` touches, as of the batches before it, and those buckets."""
    spark = batch.sparkSession
    versions.create(spark, path, schema)
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())
    state = versions.read(spark, path, schema, F.col(versions.PART).isin(touched), before=batch_id)
    return state.drop(versions.PART), touched


def store_state(
    state: DataFrame, path: str, keys: Sequence[str], batch_id: int, touched: list[str], buckets: int = STATE_BUCKETS
) -> None:
    """Replace the touched buckets."""
    parts = state.sparkSession.createDataFrame([(t,) for t in touched], "part string")
    versions.publish(state, path, bucket_of(keys, buckets), batch_id, True, parts)


def score_increment(
    batch: DataFrame,
    state: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = ("seq",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    **blocks,
) -> DataFrame:
    """Score the rows that follow on ``state``, the summary of each key's open epoch.

    Adds ``zscore``, ``is_anomaly`` and ``_epoch`` (0 for rows that go on with the stored epoch).
    """
    keys = list(keys)
    carried = state.select(*keys, stats.summary(*[F.col(c) for c in _MOMENTS]).alias("_carry"))
    small = state.limit(STATE_BROADCAST_ROWS + 1).count() <= STATE_BROADCAST_ROWS
    rows = null_safe_join(batch, carried, keys, "left", small)
    rows = rows.withColumn("_carry", F.coalesce("_carry", stats.empty_summary()))
    rows = rows.withColumn("_start", F.col("_carry")["n"])
    placed = ordered_blocks(rows, keys, order, align=size, start="_start", **blocks).where(OWN)
    placed = placed.withColumn(EPOCH, F.expr(f"{POS} div {size}"))
    before = (
        Window.partitionBy(*keys, BLOCK, EPOCH).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    )
    v = F.col(value)
    base = F.when(F.col(EPOCH) == 0, stats.merge_stats(F.col("_carry"), F.col("_local"))).otherwise(F.col("_local"))
    scored = placed.withColumn("_local", stats.summary_of(v, before)).withColumn("_base", base)
    b = F.col("_base")
    return (
        scored.withColumn("zscore", stats.zscore(v, b["n"], b["mean"], stats.stddev(b)))
        .withColumn("is_anomaly", stats.is_anomaly(F.col("zscore"), threshold))
        .select(*batch.columns, "zscore", "is_anomaly", EPOCH)
    )


def next_state(scored: DataFrame, state: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The state after the scored rows: each key's last epoch, and the keys that were not seen."""
    keys = list(keys)
    epochs = scored.groupBy(*keys, EPOCH).agg(stats.summary_of(F.col(value)).alias("_s"))
    last = epochs.groupBy(*keys).agg(F.max_by("_s", EPOCH).alias("_s"), F.max(EPOCH).alias(EPOCH))
    old = state.select(*keys, stats.summary(*[F.col(c) for c in _MOMENTS]).alias("_old"))
    both = last.unionByName(old, allowMissingColumns=True).groupBy(*keys)
    both = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_old", "_s", EPOCH)])
    merged = (
        F.when(F.col("_s").isNull(), F.col("_old"))
        .when((F.col(EPOCH) == 0) & F.col("_old").isNotNull(), stats.merge_stats(F.col("_old"), F.col("_s")))
        .otherwise(F.col("_s"))
    )
    both = both.select(*keys, merged.alias("_m"))
    return both.select(*keys, *[F.col("_m")[c].alias(c) for c in _MOMENTS])


def score_rows(
    write: Callable[[DataFrame, int], None],
    path: str,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = ("seq",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    sliding: bool = False,
    **blocks,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds ``zscore`` and ``is_anomaly`` to clean rows and hands them to ``write``.

    The state in ``path`` is a summary per key, or, for ``sliding`` baselines, a key's last ``size``
    rows. ``write`` gets the batch id to write under; the state is committed after it, and a batch whose commit
    is found is not run again.
    """
    keys, order = list(keys), list(order)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = [*keys, *[c for c in order if c not in keys], value]
        schema = T.StructType([batch.schema[c] for c in kept]) if sliding else summary_state(batch, keys)
        versions.create(spark, path, schema)
        if versions.committed(spark, path, batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        state, touched = stored_state(batch, path, schema, keys, batch_id)
        if sliding:
            scored, after = _slide(batch, state, keys, value, order, size, threshold, **blocks)
        else:
            scored = score_increment(batch, state, keys, value, order, size, threshold, **blocks)
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
            after = next_state(scored, state, keys, value)
        write(scored.select(*batch.columns, "zscore", "is_anomaly"), batch_id)
        store_state(after.select(*schema.fieldNames()), path, keys, batch_id, touched)
        scored.unpersist()
        batch.unpersist()

    return run


def _slide(batch, recent, keys, value, order, size, threshold, **blocks) -> tuple[DataFrame, DataFrame]:
    """Scores against the ``size`` rows before each, stored ones first, and the last ``size`` rows of each key."""
    both = batch.withColumn("_new", F.lit(1)).unionByName(recent.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    scored = score_sliding(both, keys, value, ["_new", *order], size, threshold, **blocks).where("_new = 1")
    # a limit on a row number is applied in each task before the shuffle
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ("_new", *order)])
    after = both.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= size)
    return scored, after


@dataclass(frozen=True)
class Feed:
    """What to read from the raw text, and which column is scored per which key."""

    name: str
    table: str
    check: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    value: str


TICK_FEED = Feed(
    "ticks", "ticks", validate.check_ticks, ("event_time", "symbol", "price", "volume"), ("symbol",), "price"
)
SENSOR_FEED = Feed(
    "sensors",
    "sensor_readings",
    validate.check_sensors,
    ("event_time", "machine_id", "sensor_id", "sensor_type", "value"),
    ("sensor_id",),
    "value",
)


@dataclass(frozen=True)
class Folders:
    """Where a pipeline keeps its tables, all in storage shared by the executors."""

    table: str
    dead_letters: str
    state: str
    metrics: str


def score_batches(
    feed: Feed,
    folders: Folders,
    order: Sequence[str] = ("offset",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    **blocks,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: validate, score, append, set aside, count, carry the state on.

    Everything written is addressed by the batch id, so a batch that is run again after a failure
    replaces its own output; the state is committed last, and a batch whose commit is found is done.
    """
    keys = list(feed.keys)

    def run(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        if batch_id and versions.committed(spark, folders.state, batch_id):
            return
        checked = feed.check(raw).persist(StorageLevel.MEMORY_AND_DISK)
        good = checked.where(F.col("reason").isNull()).select(*order, *feed.columns)
        good = good.withColumn("event_time", to_event_ts(F.col("event_time")))
        state, touched = stored_state(good, folders.state, summary_state(good, keys), keys, batch_id)
        scored = score_increment(good, state, keys, feed.value, order, size, threshold, **blocks)
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        began = time.time()
        append_scored(scored.select(*feed.columns, "zscore", "is_anomaly"), batch_id, folders.table)
        seconds = time.time() - began
        rejected = checked.where(F.col("reason").isNotNull())
        write_dead_letters(rejected, feed.name, F.current_timestamp(), batch_id, folders.dead_letters)
        write_stats(spark, feed, folders.metrics, batch_id, scored, rejected, seconds)
        store_state(next_state(scored, state, keys, feed.value), folders.state, keys, batch_id, touched)
        scored.unpersist()
        checked.unpersist()

    return run


def write_stats(spark, feed: Feed, path: str, batch_id: int, scored: DataFrame, rejected: DataFrame, seconds: float) -> None:
    """Counts and write time of one batch as metric samples."""
    row = scored.agg(F.count(F.lit(1)), F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0))).first()
    stream, table = {"stream": feed.name}, {"table": feed.table}
    now = time.time()
    values = [
        ("events", stream, row[0]),
        ("anomalies", stream, row[1] or 0),
        ("dead_letters", stream, rejected.count()),
        ("last_batch_rows", table, row[0]),
        ("write_seconds", table, seconds),
    ]
    samples = spark.createDataFrame(
        [(n, labels, float(v)) for n, labels, v in values], "name string, labels map<string,string>, value double"
    )
    samples = samples.withColumn("ts", F.timestamp_seconds(F.lit(now))).select(*METRIC_SAMPLES.fieldNames())
    samples.coalesce(1).write.mode("overwrite").parquet(f"{path}/stream={feed.name}/batch_id={batch_id}")
