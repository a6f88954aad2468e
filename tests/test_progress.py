"""Progress reports as counters, and rates of them over trailing ranges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import fleet, health
from tidegauge.streaming.progress import ProgressCounters


def report(run, batch, second, rows, anomalies, millis):
    return {
        "runId": run,
        "batchId": batch,
        "timestamp": f"2024-05-01T10:00:{second:02d}.000Z",
        "numInputRows": rows,
        "observedMetrics": {"ticks": {"events": rows, "anomalies": anomalies}},
        "durationMs": {"addBatch": millis},
    }


REPORTS = [
    report("r1", 0, 0, 100, 2, 4),
    report("r1", 1, 10, 50, None, 30),
    report("r1", 1, 10, 50, None, 30),  # seen before
    report("r2", 2, 20, 70, 1, 20_000),  # a restart
    {**report("r2", 3, 25, 0, 0, 0), "durationMs": {}},  # nothing was run
    report("r2", 4, 30, 30, 0, 30),
]


def test_counters_count_up_and_restart(spark):
    counters = ProgressCounters("ticks", "ticks")
    counters.record_all(REPORTS)
    samples = counters.flush(spark).cache()
    value = lambda name: [r.value for r in samples.where(F.col("name") == name).orderBy("ts").collect()]
    assert value("events_total") == [100, 150, 70, 100]
    assert value("anomalies_total") == [2, 2, 1, 1]
    last = samples.where("name = 'write_seconds_bucket'").where("ts = '2024-05-01 10:00:30'")
    found = {r.le: r.value for r in last.select(F.col("labels")["le"].alias("le"), "value").collect()}
    assert found["0.025"] == 0 and found["0.05"] == 1 and found["10.0"] == 1 and found["+Inf"] == 2
    # the rates that are read from them
    events = samples.where("name = 'events_total'").withColumn("stream", F.col("labels")["stream"])
    rate = health.trailing_rate(events, ["stream"], "30 seconds", "30 seconds").collect()
    # (10:00:00, 10:00:30]: from 150 at :10 to 70 after a restart and 100
    assert [(r.increase, r.samples, r.per_second) for r in rate] == [(100.0, 3, 5.0)]
    assert counters.flush(spark).count() == 0


def brute_rates(rows, width, step):
    out = {}
    ends = {-(-t // step) * step + h * step for t, _ in rows for h in range(width // step)}
    for at in ends:
        held = [(t, v) for t, v in rows if at - width < t <= at]
        if len(held) > 1 and held[-1][0] > held[0][0]:
            rise = sum(b if b < a else b - a for (_, a), (_, b) in zip(held, held[1:]))
            out[at] = (rise, len(held), rise / (held[-1][0] - held[0][0]))
    return out


@pytest.mark.parametrize("block_rows", [1_000_000, 40])
def test_trailing_rates_equal_brute_force(spark, block_rows):
    series = {"a": [(i * 7 % 5 + 4 * i, float(i * i % 90)) for i in range(200)], None: [(15 * i, float(i)) for i in range(60)]}
    series["one"] = [(30, 5.0)]
    # one sample at a time, so that the order is clear
    kept = {k: sorted(dict(vs).items()) for k, vs in series.items()}
    rows = [(k, dt.datetime(2024, 5, 1) + dt.timedelta(seconds=t), v) for k, vs in kept.items() for t, v in vs]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    found = health.trailing_rate(df, ["k"], "1 minute", "15 seconds", block_rows=block_rows).collect()
    got = {(r.k, int((r.at - dt.datetime(2024, 5, 1)).total_seconds())): (r.increase, r.samples, pytest.approx(r.per_second)) for r in found}
    want = {(k, at): v for k, vs in kept.items() for at, v in brute_rates(vs, 60, 15).items()}
    assert got == want


def test_coverage_lists_what_is_missing_from_the_buckets_that_count(spark):
    day = dt.datetime(2024, 5, 1)
    rows = [(day + dt.timedelta(minutes=m), f"s{s}") for s in range(3) for m in range(0, 6000, 60) if (m // 60 * (s + 2)) % 5]
    rows = [r for r in rows if r[0] < day + dt.timedelta(hours=70)] + [(day + dt.timedelta(hours=300), "s1"), (day, "unknown")]
    readings = spark.createDataFrame(rows, "event_time timestamp, sensor_id string")
    dimension = spark.createDataFrame([("m", f"s{s}", "t") for s in range(4)], "machine_id string, sensor_id string, sensor_type string")
    found = {(r.bucket, r.sensor_id) for r in fleet.fleet_coverage(readings, dimension, "1 hour").collect()}
    hours = {t.replace(minute=0) for t, _ in rows}
    want = {(h, f"s{s}") for h in hours for s in range(4)} - {(t.replace(minute=0), s) for t, s in rows}
    assert found == want
    assert fleet.fleet_coverage(readings.limit(0), dimension, "1 hour").collect() == []
