"""Baselines and z-scores per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.stats import BASELINE_ROWS, Z_THRESHOLD
from .blocks import BLOCK, OWN, POS, ordered_blocks

EPOCH = "_epoch"
_TILE = "_tile"
TILED_FROM = 32  # window sizes from which sliding frames are merged from tiles


def _moments(value: str, window) -> list[Column]:
    v = F.col(value)
    return [F.count(v).over(window), F.avg(v).over(window), F.stddev_samp(v).over(window)]


def epoch_baseline(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    size: int = BASELINE_ROWS,
    **blocks,
) -> DataFrame:
    """Statistics of the points before each row, starting afresh after every ``size`` points.

    Adds ``base_n``, ``base_mean`` and ``base_sd``. An epoch never leaves its block, so the key's
    only shuffle is the one that forms the blocks.
    """
    keys = list(keys)
    placed = ordered_blocks(df, keys, order, align=size, **blocks)
    placed = placed.where(OWN).withColumn(EPOCH, F.expr(f"{POS} div {size}"))
    before = (
        Window.partitionBy(*keys, BLOCK, EPOCH)
        .orderBy(POS)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    n, mean, sd = _moments(value, before)
    return placed.select(
        *df.columns, n.alias("base_n"), mean.alias("base_mean"), sd.alias("base_sd")
    )


def with_score(df: DataFrame, value: str, threshold: float = Z_THRESHOLD) -> DataFrame:
    """Turn the ``base_*`` columns into ``zscore`` and ``is_anomaly``."""
    z = stats.zscore(F.col(value), F.col("base_n"), F.col("base_mean"), F.col("base_sd"))
    scored = df.withColumn("zscore", z).drop("base_n", "base_mean", "base_sd")
    return scored.withColumn("is_anomaly", stats.is_anomaly(F.col("zscore"), threshold))


def score(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = ("seq",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    **blocks,
) -> DataFrame:
    return with_score(epoch_baseline(df, keys, value, order, size, **blocks), value, threshold)


def score_ticks(df: DataFrame, order: Sequence[str] = ("seq",), **options) -> DataFrame:
    return score(df, ["symbol"], "price", order, **options)


def score_sensors(df: DataFrame, order: Sequence[str] = ("seq",), **options) -> DataFrame:
    return score(df, ["sensor_id"], "value", order, **options)


def sliding_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    size: int,
    **blocks,
) -> DataFrame:
    """Summary ``stats`` of exactly the last ``size`` values, the current one included."""
    return _sliding(df, keys, value, order, size, True, **blocks)


def score_sliding(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = ("seq",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    **blocks,
) -> DataFrame:
    """Score each row against the previous ``size`` values, so that old behaviour is forgotten."""
    based = _sliding(df, keys, value, order, size, False, **blocks)
    base = F.col("stats")
    z = stats.zscore(F.col(value), base["n"], base["mean"], stats.stddev(base))
    return based.select(*df.columns, z.alias("zscore")).withColumn(
        "is_anomaly", stats.is_anomaly(F.col("zscore"), threshold)
    )


def _sliding(df, keys, value, order, size, current, **blocks) -> DataFrame:
    keys = list(keys)
    placed = ordered_blocks(df, keys, order, align=size, halo=size, **blocks)
    v, end = F.col(value), 0 if current else -1
    by_pos = Window.partitionBy(*keys, BLOCK).orderBy(POS)
    if size < TILED_FROM:
        frame = by_pos.rowsBetween(end - size + 1, end)
        found = stats.summary_of(v, frame)
        return placed.withColumn("stats", found).where(OWN).select(*df.columns, "stats")

    # A frame over the last `size` rows would be summed up anew for each row. Cut the positions
    # into tiles of `size`: the frame is the tail of one tile and the head of the next, so two
    # running summaries and one merge give it in constant time, without subtracting sums.
    tile = Window.partitionBy(*keys, BLOCK, _TILE)

    tail = tile.orderBy(F.desc(POS)).rowsBetween(Window.unboundedPreceding, 0)
    head = tile.orderBy(POS).rowsBetween(Window.unboundedPreceding, end)
    reach = size - 1 if current else size
    tiled = (
        placed.withColumn(_TILE, F.expr(f"{POS} div {size}"))
        .withColumn("_tail", stats.summary_of(v, tail))
        .withColumn("_head", stats.summary_of(v, head))
        .withColumn("_from", F.lag(_TILE, reach).over(by_pos))
        .withColumn("_tail", F.lag("_tail", reach).over(by_pos))
    )
    earlier = F.when(F.col("_from") < F.col(_TILE), F.col("_tail"))
    found = stats.merge_stats(F.coalesce(earlier, stats.empty_summary()), F.col("_head"))
    return tiled.withColumn("stats", found).where(OWN).select(*df.columns, "stats")


def running_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``count, mean, m2, lo, hi, variance, stddev`` per key; variance is 0.0 below two points."""
    grouped = df.groupBy(*keys).agg(stats.summary_of(F.col(value)).alias("_s"))
    return grouped.select(*keys, *_spread_out(F.col("_s")))


def merge_summaries(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine two tables of ``running_stats`` without going back to their rows."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        packed = stats.summary(*[F.col(c) for c in ("count", "mean", "m2", "lo", "hi")])
        # a NULL key is a key: it meets its like
        same = [F.struct(F.col(k)).alias(f"_{i}") for i, k in enumerate(keys)]
        return df.select(*same, packed.alias(name))

    on = [f"_{i}" for i in range(len(keys))]
    both = packed(a, "_a").join(packed(b, "_b"), on, "full")
    both = both.select(*[F.col(c)[k].alias(k) for c, k in zip(on, keys)], "_a", "_b")
    merged = stats.merge_stats(
        F.coalesce(F.col("_a"), stats.empty_summary()), F.coalesce(F.col("_b"), stats.empty_summary())
    )
    return both.select(*keys, merged.alias("_s")).select(*keys, *_spread_out(F.col("_s")))


def _spread_out(s: Column) -> list[Column]:
    return [
        s["n"].alias("count"),
        s["mean"].alias("mean"),
        s["m2"].alias("m2"),
        s["lo"].alias("lo"),
        s["hi"].alias("hi"),
        stats.variance(s).alias("variance"),
        stats.stddev(s).alias("stddev"),
    ]
