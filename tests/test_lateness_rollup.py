import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import times
from tidegauge.operators import lateness, rollup
from tidegauge.schemas import SENSOR_READINGS_1M, TICKS_1M

T0 = dt.datetime(2024, 5, 1, 12, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}])
def test_watermark_is_the_largest_time_of_earlier_batches(spark, options):
    rng = random.Random(2)
    rows = [(b, 1000 * b + rng.randrange(-5000, 2000)) for b in range(0, 5000, 7) for _ in range(3)]
    df = spark.createDataFrame(rows, "batch long, ms long")
    marked = lateness.mark_late(df, "batch", "ms", 1500, **options).collect()
    tops = {}
    for b, ms in rows:
        tops[b] = max(ms, tops.get(b, ms))
    marks, top = {}, None
    for b in sorted(tops):
        marks[b] = top
        top = tops[b] if top is None else max(top, tops[b])
    assert len(marked) == len(rows)
    for r in marked:
        assert r.watermark_ms == marks[r.batch]
        assert r.late == (marks[r.batch] is not None and r.ms < marks[r.batch] - 1500)


def test_nothing_is_late_in_the_first_batch_and_the_split_is_whole(spark):
    df = spark.createDataFrame([(0, 10, "a"), (0, 99, "b"), (1, 20, "c"), (1, 95, "d")], "batch long, ms long, id string")
    on_time, late = lateness.split_late(df, "batch", "ms", 5)
    assert sorted(r.id for r in on_time.collect()) == ["a", "b", "d"]
    assert [(r.id, r.watermark_ms) for r in late.collect()] == [("c", 99)]


def ticks(spark, rows):
    return spark.createDataFrame(rows, "event_time timestamp, symbol string, price double, is_anomaly boolean")


def sensors(spark, rows):
    return spark.createDataFrame(
        rows, "event_time timestamp, machine_id string, sensor_type string, value double, is_anomaly boolean"
    )


def test_tick_rollup(spark):
    df = ticks(spark, [(at(1), "A", 1.0, True), (at(59), "A", 4.0, None), (at(60), "A", 9.0, False), (at(2), "B", 2.0, True)])
    rows = rollup.rollup_ticks(df).orderBy("bucket", "symbol").collect()
    assert [tuple(r) for r in rows] == [
        (T0, "A", 2.5, 4.0, 1.0, 2, 1),
        (T0, "B", 2.0, 2.0, 2.0, 1, 1),
        (at(60), "A", 9.0, 9.0, 9.0, 1, 0),
    ]


def test_sensor_rollup_pools_sensors_and_one_reading_has_no_stddev(spark):
    df = sensors(spark, [(at(1), "m", "t", 1.0, False), (at(2), "m", "t", 3.0, True), (at(3), "m", "p", 5.0, False)])
    rows = {r.sensor_type: r for r in rollup.rollup_sensors(df).collect()}
    assert rows["t"].stddev_value == pytest.approx(2**0.5) and rows["t"].reading_count == 2
    assert rows["p"].stddev_value is None


def test_bucket_origin_is_a_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1, 12),)], "t timestamp")
    week = df.select(times.time_bucket("7 days", F.col("t")).alias("b")).first().b
    assert week == dt.datetime(2024, 4, 29)


def refreshed(spark, tmp_path, raws, **options):
    path = str(tmp_path / "rollup")
    rollup.create_rollup(spark, path, TICKS_1M)
    assert rollup.read_rollup(spark, path, TICKS_1M).count() == 0
    for raw, now, opts in raws:
        rollup.refresh_rollup(raw, rollup.rollup_ticks, path, TICKS_1M, now, **opts)
    return path


def counts(spark, path):
    table = rollup.read_rollup(spark, path, TICKS_1M)
    return {r.bucket: r.tick_count for r in table.collect()}


def test_refresh_covers_whole_buckets_of_the_range_only(spark, tmp_path):
    raw = ticks(spark, [(at(s), "A", 1.0, False) for s in range(-1200, 1200, 10)])
    path = refreshed(spark, tmp_path, [(raw, at(0), {})])
    # [-600, -60)
    assert sorted(counts(spark, path)) == [at(60 * m) for m in range(-10, -1)]
    rollup.refresh_rollup(raw, rollup.rollup_ticks, path, TICKS_1M, at(30))
    # [-570, -30): the buckets that begin at -600 and -60 are not whole inside
    assert sorted(counts(spark, path)) == [at(60 * m) for m in range(-10, -1)]


def test_refresh_leaves_other_buckets_untouched_and_repeats(spark, tmp_path):
    old = ticks(spark, [(at(s), "A", 1.0, False) for s in range(-3600, 0, 30)])
    path = refreshed(spark, tmp_path, [(old, at(0), {"full": True})])
    before = counts(spark, path)
    assert len(before) == 59 and set(before.values()) == {2}
    new = ticks(spark, [(at(s), "A", 1.0, False) for s in range(-3600, 0, 10)])
    for _ in range(2):
        rollup.refresh_rollup(new, rollup.rollup_ticks, path, TICKS_1M, at(0))
        after = counts(spark, path)
        assert after == {b: 6 if b >= at(-600) else 2 for b in before}


def test_refresh_empties_an_hour_whose_rows_are_gone(spark, tmp_path):
    raw = ticks(spark, [(at(-7200 + 60), "A", 1.0, False), (at(-60 * 70), "A", 1.0, False), (at(-300), "A", 1.0, False)])
    path = refreshed(spark, tmp_path, [(raw, at(0), {"full": True})])
    assert len(counts(spark, path)) == 3
    gone = raw.where(F.col("event_time") > F.lit(at(-3600)))
    rollup.refresh_rollup(gone, rollup.rollup_ticks, path, TICKS_1M, at(0), start_offset="3 hours")
    assert sorted(counts(spark, path)) == [at(-300)]


def test_rollup_range_reads_only_its_hours(spark, tmp_path):
    raw = ticks(spark, [(at(s), "A", 1.0, False) for s in range(-36000, 0, 600)])
    path = refreshed(spark, tmp_path, [(raw, at(0), {"full": True})])
    found = rollup.rollup_between(spark, path, TICKS_1M, "2024-05-01 08:10:00", "2024-05-01 09:10:00")
    assert found.count() == 7
    assert len(found.inputFiles()) > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_sensor_refresh(spark, tmp_path):
    path = str(tmp_path / "r")
    df = sensors(spark, [(at(-300), "m", "t", 1.0, False), (at(-290), "m", "t", 3.0, True)])
    rollup.create_rollup(spark, path, SENSOR_READINGS_1M)
    rollup.refresh_rollup(df, rollup.rollup_sensors, path, SENSOR_READINGS_1M, at(0))
    row = rollup.read_rollup(spark, path, SENSOR_READINGS_1M).first()
    assert (row.reading_count, row.anomaly_count, row.bucket) == (2, 1, at(-300))
