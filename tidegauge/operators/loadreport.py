"""Summary of a load ramp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the report.
BREAKING = "BREAKING (lag growing unbounded)"
STABLE = "stable"


def load_stage_summary(samples: DataFrame, starts: DataFrame) -> DataFrame:
    """One row per stage: mean rate, worst p99, lag growth since the stage began, verdict.

    A stage breaks when its lag grew by more than one second's worth of events. A stage without a start row
    stays, with neither growth nor verdict.
    """
    stages = samples.groupBy("hz").agg(
        F.avg("events_per_s").alias("_rate"),
        F.max("p99_s").alias("_p99"),
        F.max_by("lag", F.struct("ts", "lag")).alias("_last"),
    )
    growth = F.col("_last") - F.col("start_lag")
    return stages.join(starts, "hz", "left").select(
        "hz",
        F.bround("_rate", 1).alias("avg_events_per_s"),
        F.bround(growth, 0).alias("lag_growth"),
        F.bround(F.col("_p99") * 1000, 1).alias("max_p99_write_ms"),
        F.when(growth > F.col("_rate"), F.lit(BREAKING)).when(growth.isNotNull(), F.lit(STABLE)).alias("verdict"),
    )


def find_ceiling(summary: DataFrame) -> DataFrame:
    """The lowest breaking stage, or one row of NULLs when none broke."""
    breaking = summary.where(F.col("verdict") == BREAKING)
    return breaking.agg(
        F.min("hz").alias("ceiling_hz"), F.min_by("avg_events_per_s", "hz").alias("avg_events_per_s")
    )
