import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import times
from tidegauge.operators import fleet, health, loadreport

T0 = dt.datetime(2024, 5, 1, 12, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("options", [{}, {"block_rows": 2}])
def test_counter_rate_with_a_restart(spark, options):
    rows = [("a", at(s), v) for s, v in [(0, 5.0), (10, 9.0), (20, 2.0), (30, 6.0), (60, 7.0), (119, 7.0), (200, 1.0)]]
    df = spark.createDataFrame(rows, "stream string, ts timestamp, value double")
    found = {r.window_start: r for r in health.counter_rate(df, ["stream"], "1 minute", **options).collect()}
    assert set(found) == {at(0), at(60)}
    assert found[at(0)].increase == 10.0 and found[at(0)].per_second == pytest.approx(10 / 30)
    assert found[at(60)].per_second == 0.0


def test_event_rate_hopping_equals_direct_counts(spark):
    seconds = [0, 3, 12, 29, 30, 61, 62, 65, 300]
    df = spark.createDataFrame([(at(s), s % 2 == 0) for s in seconds], "event_time timestamp, flag boolean")
    rows = health.event_rate(df.withColumn("k", F.lit("x")), ["k"], "1 minute", "10 seconds").collect()
    got = {r.window_start: round(r.per_second * 60) for r in rows}
    want = {}
    for s in range(-60, 310, 10):
        n = sum(1 for x in seconds if s <= x < s + 60)
        if n:
            want[at(s)] = n
    assert got == want
    flagged = health.event_rate(df, [], "1 minute", flag="flag").collect()
    assert {r.window_start: round(r.per_second * 60) for r in flagged} == {at(0): 3, at(60): 1, at(300): 1}
    with pytest.raises(ValueError):
        health.event_rate(df, [], "1 minute", "7 seconds")


def test_histogram(spark):
    df = spark.createDataFrame([("t", v) for v in (0.01, 0.02, 0.05, 0.3, 0.5, 4.0)], "table string, s double")
    buckets = health.cumulative_buckets(df, "s", [0.02, 0.1, 1.0], ["table"])
    assert [(r.le, r.value) for r in buckets.collect()] == [("0.02", 2.0), ("0.1", 3.0), ("1.0", 5.0), ("+Inf", 6.0)]

    def quantile(q):
        return health.histogram_quantile(buckets, q, ["table"]).first().quantile

    assert quantile(0.5) == pytest.approx(0.1)
    assert quantile(4 / 6) == pytest.approx(0.55)
    assert quantile(1 / 6) == pytest.approx(0.01)
    assert quantile(0.99) == 1.0
    empty = spark.createDataFrame([("0.1", 0.0), ("+Inf", 0.0)], "le string, value double")
    assert health.histogram_quantile(empty, 0.5).first().quantile is None


def test_instant_value_and_labels(spark):
    rows = [(at(0), "m", {"g": "b"}, 1.0), (at(5), "m", {"g": "a"}, 2.0), (at(9), "m", {"g": "a"}, 3.0)]
    df = spark.createDataFrame(rows, "ts timestamp, name string, labels map<string,string>, value double")
    assert health.instant_value(df, "m").first().value == 3.0
    assert health.instant_value(df, "m", "2024-05-01 12:00:06").first().value == 2.0
    assert health.instant_value(df, "none").first().value == 0.0
    assert {r.g: r.value for r in health.label_rollup(df, ["g"]).collect()} == {"a": 5.0, "b": 1.0}
    assert health.label_rollup(df).first().value == 6.0


def test_lag_and_counters(spark):
    offsets = spark.createDataFrame([("g", "t", 0, 10, 4), ("g", "t", 1, 5, 5), ("h", "t", 0, 7, 0)], "grp string, topic string, partition int, log_end long, committed long")
    assert {r.grp: r.lag for r in health.consumer_lag(offsets).collect()} == {"g": 6, "h": 7}
    flags = spark.createDataFrame([(True,), (False,), (None,)], "is_anomaly boolean")
    found = {r.stream: tuple(r)[1:] for r in health.stream_counters({"a": flags, "b": flags.limit(0)}, {"a": flags}).collect()}
    assert found == {"a": (3, 1, 3), "b": (0, 0, 0)}


def test_load_report(spark):
    samples = spark.createDataFrame(
        [(5, at(0), 10.0, 100.0, 0.01), (5, at(10), 20.0, 115.0, 0.03), (10, at(0), 20.0, 0.0, 0.5), (10, at(10), 20.25, 21.0, 0.25)],
        "hz int, ts timestamp, events_per_s double, lag double, p99_s double",
    )
    starts = spark.createDataFrame([(5, 100.0), (10, 0.0)], "hz int, start_lag double")
    summary = loadreport.load_stage_summary(samples, starts)
    rows = {r.hz: tuple(r)[1:] for r in summary.collect()}
    # growth equal to the rate is still stable
    assert rows[5] == (15.0, 15.0, 30.0, "stable")
    assert rows[10] == (20.1, 21.0, 500.0, "BREAKING (lag growing unbounded)")
    assert tuple(loadreport.find_ceiling(summary).first()) == (10, 20.1)
    assert tuple(loadreport.find_ceiling(summary.where("hz = 5")).first()) == (None, None)


def test_sensor_dimension_and_coverage(spark):
    machines = spark.createDataFrame([(f"machine-{i:02d}",) for i in range(1, 6)], "machine_id string")
    dimension = fleet.sensor_dimension(machines).cache()
    rows = dimension.collect()
    assert len(rows) == 50 and len({r.sensor_id for r in rows}) == 50
    assert {r.sensor_id for r in rows if r.machine_id == "machine-01" and r.sensor_index in (0, 9)} == {
        "machine-01-s00-temperature", "machine-01-s09-temperature"}
    # day 1 lacks one sensor, day 2 has no reading at all, day 3 has a single sensor
    ids = [r.sensor_id for r in rows]
    day = 86400
    readings = [(at(0), s) for s in ids[1:]] + [(at(5), ids[1])] + [(at(2 * day), ids[7])]
    df = spark.createDataFrame(readings, "event_time timestamp, sensor_id string")
    missing = fleet.fleet_coverage(df, dimension, "1 day").collect()
    per_day = {}
    for r in missing:
        per_day.setdefault(r.bucket.day, set()).add(r.sensor_id)
    assert per_day == {1: {ids[0]}, 3: set(ids) - {ids[7]}}


def test_detector_quality(spark):
    rows = [("t", True, True)] * 3 + [("t", True, False)] + [("t", False, True)] * 2 + [("t", False, None)] * 4 + [("p", False, False)]
    df = spark.createDataFrame(rows, "sensor_type string, is_anomaly boolean, anomaly_injected boolean")
    found = {r.sensor_type: tuple(r)[1:] for r in fleet.detector_quality(df).collect()}
    assert found["t"] == (3, 1, 2, 4, 0.75, 0.6) and found["p"] == (0, 0, 0, 1, None, None)


def test_series_forms(spark):
    df = spark.createDataFrame([(at(0), "m", "t", 1.0), (at(0), "m", None, 2.0), (at(60), "n", "t", 3.0)], "b timestamp, machine_id string, sensor_type string, v double")
    series = times.as_series(df, "b", times.machine_label(), "v")
    assert {(r.metric, r.value) for r in series.collect()} == {("m/t", 1.0), (None, 2.0), ("n/t", 3.0)}
    wide = {r.time: tuple(r)[1:] for r in times.wide_series(series, ["m/t", "n/t"]).collect()}
    assert wide == {at(0): (1.0, None), at(60): (None, 3.0)}


def test_event_time_keeps_milliseconds(spark):
    row = spark.createDataFrame([(1704067211172,)], "ms long").select(times.to_event_ts(F.col("ms")).alias("t")).first()
    assert row.t == dt.datetime(2024, 1, 1, 0, 0, 11, 172000)
    assert math.isclose(times.width_seconds("1 hour 30 minutes"), 5400)
