"""Summaries, scores and flags against two-pass arithmetic in plain Python."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.operators import fleet, scoring

SERIES = {
    "climbing": [0.5 * i for i in range(9)],
    "wide": [-4e6, 3.25, 8e6, -1.5e6, 0.0],
    "small": [1e-7, 3e-7, 2e-7],
    "far": [1e9 + d for d in (0.25, 0.5, 0.75, 0.125)],
    "pair": [7.5, -7.5],
    "one": [42.0],
}


def summary_of(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return df.agg(stats.summary_of(F.col("x")).alias("s"))


def z_of(spark, values, x):
    s = F.col("s")
    z = stats.zscore(F.lit(float(x)), s["n"], s["mean"], stats.stddev(s))
    return summary_of(spark, values).select(z.alias("z"), stats.is_anomaly(z).alias("flag")).first()


@pytest.mark.parametrize("name", sorted(SERIES))
def test_a_summary_is_that_of_two_passes(spark, name):
    values = SERIES[name]
    s = F.col("s")
    row = summary_of(spark, values).select("s.*", stats.variance(s).alias("v"), stats.stddev(s).alias("sd")).first()
    want = statistics.variance(values) if len(values) > 1 else 0.0
    assert (row.n, row.lo, row.hi) == (len(values), min(values), max(values))
    assert row.mean == pytest.approx(math.fsum(values) / len(values))
    assert row.v == pytest.approx(want, rel=1e-6) and row.sd == pytest.approx(math.sqrt(want), rel=1e-6)


def test_a_score_is_the_distance_in_deviations_of_what_came_before(spark):
    before = [31.0, 29.5, 30.25, 30.75, 28.0, 31.5]
    mean, sd = statistics.mean(before), statistics.stdev(before)
    for x, flag in ((mean + 3.01 * sd, True), (mean - 3.01 * sd, True), (mean + 2.99 * sd, False), (mean, False)):
        row = z_of(spark, before, x)
        assert row.z == pytest.approx((x - mean) / sd, abs=1e-9) and row.flag == flag
    # folded in first, an outlier would hide behind the spread it makes itself
    assert abs(z_of(spark, [*before, 60.0], 60.0).z) < 3 < abs(z_of(spark, before, 60.0).z)


@pytest.mark.parametrize("before", [[], [17.0], [0.7] * 11])
def test_without_spread_there_is_no_score(spark, before):
    row = z_of(spark, before, 1e6)
    assert row.z == 0.0 and not row.flag


def test_flags_need_more_than_the_threshold(spark):
    cases = {2.5: False, 3.0: False, 3.0 + 1e-12: True, -3.0: False, -7.25: True, math.inf: True, math.nan: False, None: False}
    rows = spark.createDataFrame([(z,) for z in cases], "z double")
    assert [r[0] for r in rows.select(stats.is_anomaly(F.col("z"))).collect()] == list(cases.values())


def test_merging_any_cut_equals_one_pass(spark):
    rng = random.Random(11)
    values = [rng.gauss(100, 15) for _ in range(40)]
    whole = summary_of(spark, values).select("s.*").first()
    for cut in (0, 1, 13, 39, 40):
        left, right = (summary_of(spark, part).collect()[0].s for part in (values[:cut], values[cut:]))
        both = spark.createDataFrame([(left, right)], "a struct<n:long,mean:double,m2:double,lo:double,hi:double>, b struct<n:long,mean:double,m2:double,lo:double,hi:double>")
        m = both.select(stats.merge_stats(F.col("a"), F.col("b")).alias("m")).select("m.*").first()
        assert (m.n, m.lo, m.hi) == (whole.n, whole.lo, whole.hi)
        assert m.mean == pytest.approx(whole.mean) and m.m2 == pytest.approx(whole.m2)


def test_a_row_is_late_only_beyond_the_grace_period(spark):
    grace, mark = 250, 10_000
    cases = {mark: False, mark - grace + 1: False, mark - grace: False, mark - grace - 1: True, 0: True}
    rows = spark.createDataFrame([(e,) for e in cases], "e long")
    assert [r[0] for r in rows.select(stats.is_late(F.col("e"), F.lit(mark), grace)).collect()] == list(cases.values())
    assert not rows.select(stats.is_late(F.col("e"), F.lit(None).cast("long"), grace)).first()[0]


def test_stored_summaries_keep_their_extremes(spark):
    rows = [("flat", 0.1)] * 7 + [("x", 2.0), ("x", 5.5), (None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    half = scoring.running_stats(df, ["k"], "x")
    found = {r.k: r for r in scoring.merge_summaries(half, half, ["k"]).collect()}
    assert found["flat"].variance == 0.0 and found["flat"]["count"] == 14
    assert (found["x"].lo, found["x"].hi, found["x"]["count"]) == (2.0, 5.5, 4)
    assert found[None]["count"] == 4 and found[None].mean == 2.5
    lone = {r.k: r for r in scoring.running_stats(df.where("x = 2.0"), ["k"], "x").collect()}
    assert (lone["x"].variance, lone["x"].stddev) == (0.0, 0.0)


def test_sensor_types_follow_one_another(spark):
    rows = spark.range(7).select(fleet.sensor_type(F.col("id")).alias("t")).collect()
    assert [r.t for r in rows] == [fleet.SENSOR_TYPES[i % 3] for i in range(7)]
