"""A load stage that has samples and no start row."""

from tidegauge.operators.loadreport import STABLE, load_stage_summary


def test_stage_without_a_start_stays(spark):
    samples = spark.createDataFrame([(10, 1, 9.0, 0.1, 4.0), (20, 2, 19.0, 0.2, 6.0)], "hz int, ts long, events_per_s double, p99_s double, lag double")
    starts = spark.createDataFrame([(10, 1.0)], "hz int, start_lag double")
    found = {r.hz: (r.lag_growth, r.verdict) for r in load_stage_summary(samples, starts).collect()}
    assert found == {10: (3.0, STABLE), 20: (None, None)}
