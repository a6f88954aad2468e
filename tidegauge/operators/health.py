"""Counters, rates, latency quantiles and lag of the pipeline itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import time_bucket, time_window, width_seconds
from .blocks import BLOCK, OWN, POS, ordered_blocks


def stream_counters(
    scored: dict[str, DataFrame], rejected: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Events, anomalies and dead letters of each named stream."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("events"),
            F.coalesce(F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)), F.lit(0)).alias("anomalies"),
            F.lit(0).cast("long").alias("dead_letters"),
        ).withColumn("stream", F.lit(name))
        for name, df in scored.items()
    ]
    parts += [
        df.agg(
            F.lit(0).cast("long").alias("events"),
            F.lit(0).cast("long").alias("anomalies"),
            F.count(F.lit(1)).alias("dead_letters"),
        ).withColumn("stream", F.lit(name))
        for name, df in (rejected or {}).items()
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("stream").agg(
        F.sum("events").alias("events"),
        F.sum("anomalies").alias("anomalies"),
        F.sum("dead_letters").alias("dead_letters"),
    )


def label_rollup(samples: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Sum of the sample values by some of their labels; over everything when none is named."""
    by = [F.col("labels")[name].alias(name) for name in labels]
    return samples.groupBy(*by).agg(F.sum("value").alias("value"))


def event_rate(
    df: DataFrame,
    by: Sequence[str],
    width: str,
    slide: str | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Events (or flagged events) per second in each window.

    Hopping windows are put together from the counts of their panes, so that a row is counted once
    and not once per window it lies in.
    """
    counted = F.count(F.lit(1)) if flag is None else F.sum(F.when(F.col(flag), 1).otherwise(0))
    seconds = width_seconds(width)
    pane = slide or width
    panes = df.groupBy(time_bucket(pane, F.col("event_time")).alias("_pane"), *by).agg(counted.alias("_n"))
    if slide is None:
        return panes.select(
            F.col("_pane").alias("window_start"), *by, (F.col("_n") / seconds).alias("per_second")
        )
    if seconds % width_seconds(slide):
        raise ValueError("the window width must be a multiple of the slide")
    hops = time_window(F.col("_pane"), width, slide)
    return (
        panes.groupBy(hops.alias("_w"), *by)
        .agg((F.sum("_n") / seconds).alias("per_second"))
        .select(F.col("_w")["start"].alias("window_start"), *by, "per_second")
    )


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    width: str,
    order: Sequence[str] = ("ts",),
    time: str = "ts",
    value: str = "value",
    **blocks,
) -> DataFrame:
    """Rate of a cumulative counter in each window, from the samples inside it.

    A fall of the value is a restart from zero, so the new value is the increase. The rate is the
    increase from the first to the last sample over the time between them; nothing is extrapolated
    to the window's edges. Windows with fewer than two samples have no rate.
    """
    keys = [*series, "window_start"]
    windowed = samples.withColumn("window_start", time_bucket(width, F.col(time)))
    placed = ordered_blocks(windowed, keys, order, halo=1, **blocks)
    previous = F.lag(value).over(Window.partitionBy(*keys, BLOCK).orderBy(POS))
    v = F.col(value)
    steps = placed.withColumn("_previous", previous).where(OWN)
    rise = F.when(v < F.col("_previous"), v).otherwise(v - F.col("_previous"))
    spans = steps.groupBy(*keys).agg(
        F.sum(rise).alias("increase"),
        ((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))) / 1e6).alias("_seconds"),
        F.count(F.lit(1)).alias("samples"),
    )
    return spans.where("samples > 1 AND _seconds > 0").select(
        *keys, "increase", "samples", (F.col("increase") / F.col("_seconds")).alias("per_second")
    )


def trailing_rate(
    samples: DataFrame,
    series: Sequence[str],
    width: str,
    step: str,
    order: Sequence[str] = ("ts",),
    time: str = "ts",
    value: str = "value",
    **blocks,
) -> DataFrame:
    """Rate of a cumulative counter over the trailing ``width``, at every multiple of ``step``.

    At ``at`` the samples in ``(at - width, at]`` count, as in ``counter_rate``: the increase from the first to
    the last over the time between them, restarts counted from zero, no rate below two samples. Each sample is
    put into the pane of one step with its rise over the sample before it; a pane's rises are summed once, and
    the panes of a range are put together, less the rise that leads into its first sample. So a row costs the
    same whatever the range; a pane costs ``width / step`` rows.
    """
    series = list(series)
    panes, micros = width_seconds(width) // width_seconds(step), width_seconds(step) * 1_000_000
    if width_seconds(width) % width_seconds(step):
        raise ValueError("the width must be a multiple of the step")
    placed = ordered_blocks(samples, series, order, halo=1, **blocks)
    previous, v = F.lag(value).over(Window.partitionBy(*series, BLOCK).orderBy(POS)), F.col(value)
    steps = placed.withColumn("_previous", previous).where(OWN)
    rise = F.when(v < F.col("_previous"), v).otherwise(v - F.col("_previous"))
    now = F.unix_micros(time)
    pane = (now - F.pmod(now, F.lit(micros))) / micros + F.when(F.pmod(now, F.lit(micros)) > 0, 1).otherwise(0)
    steps = steps.withColumn("_pane", pane.cast("long")).withColumn("_rise", F.coalesce(rise, F.lit(0.0)))
    made = steps.groupBy(*series, "_pane").agg(
        F.sum("_rise").alias("_rises"),
        F.min_by("_rise", POS).alias("_into"),
        F.min(now).alias("_first"),
        F.max(now).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    ends = F.explode(F.sequence("_pane", F.col("_pane") + panes - 1)).alias("_at")
    spans = made.select(*made.columns, ends).groupBy(*series, "_at").agg(
        (F.sum("_rises") - F.min_by("_into", "_pane")).alias("increase"),
        ((F.max("_last") - F.min("_first")) / 1e6).alias("_seconds"),
        F.sum("_n").alias("samples"),
    )
    return spans.where("samples > 1 AND _seconds > 0").select(
        *series,
        F.timestamp_micros(F.col("_at") * micros).alias("at"),
        "increase",
        "samples",
        (F.col("increase") / F.col("_seconds")).alias("per_second"),
    )


def trailing_quantile(
    samples: DataFrame, q: float, by: Sequence[str], width: str, step: str, le: str = "le", **options
) -> DataFrame:
    """Quantile of what a cumulative histogram counted in the trailing ``width``, at every multiple of ``step``.

    Each bound is a counter of its own: its rates are summed by ``by``, and the quantile is taken of those. It
    is NULL where nothing was counted.
    """
    rates = trailing_rate(samples, [*by, le], width, step, **options)
    return histogram_quantile(rates, q, ["at", *by], le, "per_second")


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str] = (), le: str = "le", value: str = "value"
) -> DataFrame:
    """Quantile from cumulative bucket counts, by linear interpolation inside the bucket.

    ``le`` is the upper bound as text, ``+Inf`` last. Counts are summed by bound first, so each
    group's list has one entry per bound of the histogram. A quantile in the last bucket gives the
    highest finite bound; the first bucket starts at zero if its bound is positive. Counts that fall from one
    bound to the next, as rates do whose restarts some bounds did not show, stay at what they had reached.
    """
    bound = F.when(F.col(le) == "+Inf", F.lit(float("inf"))).otherwise(F.col(le).cast("double"))
    summed = buckets.groupBy(*by, bound.alias("_le")).agg(F.sum(value).alias("_count"))
    groups = summed.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("_le", "_count"))).alias("_h")
    )
    reached = F.transform(
        "_h",
        lambda b, i: F.struct(
            b["_le"].alias("_le"), F.array_max(F.transform(F.slice("_h", F.lit(1), i + 1), lambda x: x["_count"])).alias("_count")
        ),
    )
    groups = groups.withColumn("_h", reached)
    groups = groups.withColumn("_rank", F.element_at("_h", -1)["_count"] * q)
    index = F.array_position(
        F.transform("_h", lambda b: b["_count"] >= F.col("_rank")), F.lit(True)
    ).cast("int")
    hit = F.element_at("_h", F.col("_i"))
    below = F.when(F.col("_i") > 1, F.element_at("_h", F.greatest(F.col("_i") - 1, F.lit(1))))
    low = F.coalesce(below["_le"], F.when(hit["_le"] > 0, F.lit(0.0)).otherwise(hit["_le"]))
    under = F.coalesce(below["_count"], F.lit(0.0))
    inside = low + (hit["_le"] - low) * F.try_divide(F.col("_rank") - under, hit["_count"] - under)
    total = F.element_at("_h", -1)["_count"]
    quantile = F.when(total > 0, F.when(F.isnan(hit["_le"]) | (hit["_le"] == float("inf")), low).otherwise(inside))
    return groups.withColumn("_i", index).select(*by, quantile.alias("quantile"))


def consumer_lag(offsets: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """Records written but not yet committed."""
    lag = F.sum(F.col("log_end") - F.col("committed"))
    return offsets.groupBy(*by).agg(lag.alias("lag"))


def instant_value(samples: DataFrame, name: str, at: str | None = None, default: float = 0.0) -> DataFrame:
    """One row: the value of the metric's first series (in label order) at an instant.

    A series has the value of its last sample up to ``at``; without any sample the default is given.
    """
    chosen = samples.where(F.col("name") == name)
    if at is not None:
        chosen = chosen.where(F.col("ts") <= F.lit(at).cast("timestamp"))
    labels = F.array_join(
        F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
    )
    series = chosen.groupBy(labels.alias("_labels")).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value")
    )
    return series.agg(F.coalesce(F.min_by("value", "_labels"), F.lit(default)).alias("value"))


def cumulative_buckets(
    df: DataFrame, seconds: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Histogram of a duration: for each bound the number of values up to it, as ``(*by, le, value)``.

    Each row is counted once, in its own bucket; the running sum goes over the few bounds only.
    """
    finite = sorted(bounds)
    spot = F.lit(len(finite))
    for i, bound in reversed(list(enumerate(finite))):
        spot = F.when(F.col(seconds) <= bound, F.lit(i)).otherwise(spot)
    own = df.groupBy(*by, spot.alias("_spot")).agg(F.count(F.lit(1)).alias("_n"))
    names = F.array(*[F.lit(str(b)) for b in finite], F.lit("+Inf"))
    counts = own.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_spot", "_n"))).alias("_m"))
    filled = F.transform(
        F.sequence(F.lit(0), F.lit(len(finite))),
        lambda i: F.struct(
            F.element_at(names, i + 1).alias("le"),
            F.aggregate(
                F.sequence(F.lit(0), i),
                F.lit(0).cast("long"),
                lambda total, j: total + F.coalesce(F.try_element_at("_m", j), F.lit(0)),
            ).cast("double").alias("value"),
        ),
    )
    return counts.select(*by, F.inline(filled))
