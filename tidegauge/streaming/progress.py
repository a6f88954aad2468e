"""Progress reports of streaming queries as metric samples: counters that restart, and a histogram of write times."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import METRIC_SAMPLES

# Bounds of the write-time histogram, in seconds.
WRITE_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


class ProgressCounters:
    """Counts up what a query reports; a new run of the query starts again from zero, as a restarted process does.

    ``record`` takes one report: ``query.lastProgress``, those of ``query.recentProgress`` or those that a listener is
    given, in order; a report seen before (by run and batch) is passed over. A report is a few numbers, whatever the
    rows of its batch. The samples are what ``counter_rate`` and ``trailing_quantile`` read.
    """

    def __init__(self, stream: str, table: str, bounds: Sequence[float] = WRITE_BOUNDS) -> None:
        self.stream, self.table, self.bounds = stream, table, sorted(bounds)
        self.run, self.batch = None, -1
        self.samples: list[tuple[str, str, dict[str, str], float]] = []

    def _restart(self, run: str) -> None:
        self.run, self.batch = run, -1
        self.counts = {"events": 0.0, "anomalies": 0.0}
        self.buckets = [0.0] * (len(self.bounds) + 1)

    def record(self, progress) -> None:
        run, batch = str(progress["runId"]), progress["batchId"]
        if run != self.run:
            self._restart(run)
        if batch <= self.batch or "addBatch" not in progress["durationMs"]:
            return
        self.batch = batch
        observed = progress["observedMetrics"].get(self.stream)
        found = observed.asDict() if hasattr(observed, "asDict") else dict(observed or {})
        self.counts["events"] += found.get("events", progress["numInputRows"]) or 0
        self.counts["anomalies"] += found.get("anomalies") or 0
        seconds = progress["durationMs"]["addBatch"] / 1000
        at = next((i for i, bound in enumerate(self.bounds) if seconds <= bound), len(self.bounds))
        self.buckets[at] += 1
        when = progress["timestamp"]
        for name, count in self.counts.items():
            self.samples.append((when, f"{name}_total", {"stream": self.stream}, count))
        total = 0.0
        for bound, n in zip([*map(str, self.bounds), "+Inf"], self.buckets):
            total += n
            self.samples.append((when, "write_seconds_bucket", {"table": self.table, "le": bound}, total))

    def record_all(self, reports: Iterable) -> None:
        for report in reports:
            self.record(report)

    def flush(self, spark: SparkSession) -> DataFrame:
        """The samples since the last flush as a DataFrame (``ts``, ``name``, ``labels``, ``value``)."""
        made = spark.createDataFrame(self.samples, "ts string, name string, labels map<string,string>, value double")
        self.samples = []
        return made.withColumn("ts", made.ts.cast("timestamp")).select(*METRIC_SAMPLES.fieldNames())
