"""Running-statistics expressions. A summary is ``struct(n, mean, m2, lo, hi)``.

The extremes tell a flat baseline exactly: means of equal values can differ in the last bit, and a
merge would take that for spread.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# Fixed values of the detector.
BASELINE_ROWS = 200
Z_THRESHOLD = 3.0


def summary(n: Column, mean: Column, m2: Column, lo: Column, hi: Column) -> Column:
    return F.struct(
        n.cast("long").alias("n"),
        mean.cast("double").alias("mean"),
        m2.cast("double").alias("m2"),
        lo.cast("double").alias("lo"),
        hi.cast("double").alias("hi"),
    )


def summary_of(value: Column, window: WindowSpec | None = None) -> Column:
    """Aggregate ``value`` into a summary, over a window if one is given.

    Catalyst merges the partial moments of a grouped aggregate itself.
    """

    def over(aggregate: Column) -> Column:
        return aggregate if window is None else aggregate.over(window)

    n = over(F.count(value))
    return summary(
        n,
        F.coalesce(over(F.avg(value)), F.lit(0.0)),
        F.coalesce(over(F.var_samp(value)) * (n - 1), F.lit(0.0)),
        over(F.min(value)),
        over(F.max(value)),
    )


def empty_summary() -> Column:
    return summary(F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(None), F.lit(None))


def merge_stats(a: Column, b: Column) -> Column:
    """Combine two summaries as if their points had been seen by one."""
    na, nb = a["n"], b["n"]
    n = na + nb
    gap = b["mean"] - a["mean"]
    merged = summary(
        n,
        a["mean"] + gap * nb / n,
        a["m2"] + b["m2"] + gap * gap * na * nb / n,
        F.least(a["lo"], b["lo"]),
        F.greatest(a["hi"], b["hi"]),
    )
    return (
        F.when(na.isNull() | (na == 0), F.coalesce(b, empty_summary()))
        .when(nb.isNull() | (nb == 0), a)
        .otherwise(merged)
    )


def variance(s: Column) -> Column:
    """Sample variance; 0.0 below two points, and for equal points."""
    return F.when((s["n"] < 2) | (s["lo"] == s["hi"]), F.lit(0.0)).otherwise(s["m2"] / (s["n"] - 1))


def stddev(s: Column) -> Column:
    return F.sqrt(variance(s))


def zscore(value: Column, n: Column, mean: Column, sd: Column) -> Column:
    """Distance of ``value`` from a baseline that does not contain it; 0.0 while there is none."""
    return F.when((n < 2) | (sd == 0), F.lit(0.0)).otherwise((value - mean) / sd)


def is_anomaly(z: Column, threshold: float = Z_THRESHOLD) -> Column:
    """Strictly beyond the threshold on either side. NaN would sort above it, so it is shut out."""
    return F.coalesce((F.abs(z) > threshold) & ~F.isnan(z), F.lit(False))


def is_late(event_ms: Column, watermark_ms: Column, allowed_ms: int) -> Column:
    """Older than the watermark by more than the grace period; on the limit is not late."""
    return F.coalesce(event_ms < watermark_ms - F.lit(allowed_ms), F.lit(False))
