import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from reference_math import epoch_scores, sliding_scores, welford

from tidegauge.operators import scoring
from tidegauge.streaming.state import score_recent, score_values


def series(n, seed=1):
    rng = random.Random(seed)
    values = [1e6 + rng.gauss(0, 2) for _ in range(n)]
    for i in range(30, n, 97):
        values[i] += rng.choice([-40, 40])
    return values


@pytest.fixture(scope="module")
def data(spark):
    keys = {"hot": series(1500, 1), "mid": series(450, 2), "one": [5.0], "flat": [0.1] * 260, "stuck": [5.3, 7.1] * 30 + [0.1] * 400 + [0.3]}
    rows = [(k, i, v) for k, vs in keys.items() for i, v in enumerate(vs)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq long, x double").repartition(6).cache()
    return keys, df


def by_key(df, column):
    out = {}
    for r in df.orderBy("k", "seq").collect():
        out.setdefault(r.k, []).append(r[column])
    return out


@pytest.mark.parametrize("options", [{}, {"block_rows": 400}, {"block_rows": 1}])
def test_epoch_scores_equal_the_sequential_loop(data, options):
    keys, df = data
    scored = scoring.score(df, ["k"], "x", **options).cache()
    found, flags = by_key(scored, "zscore"), by_key(scored, "is_anomaly")
    for k, values in keys.items():
        want = epoch_scores(values)
        assert found[k] == pytest.approx(want, rel=1e-6, abs=1e-6)
        assert flags[k] == [abs(z) > 3 for z in want]


def test_baseline_restarts_at_point_201(data):
    _, df = data
    z = by_key(scoring.score(df, ["k"], "x"), "zscore")["mid"]
    assert [i for i, v in enumerate(z) if v == 0.0] == [0, 1, 200, 201, 400, 401]


@pytest.mark.parametrize("size,options", [(200, {}), (50, {"block_rows": 300}), (7, {"block_rows": 100}), (40, {"block_rows": 1})])
def test_sliding_scores_equal_the_sequential_loop(data, size, options):
    keys, df = data
    found = by_key(scoring.score_sliding(df, ["k"], "x", size=size, **options), "zscore")
    for k, values in keys.items():
        assert found[k] == pytest.approx(sliding_scores(values, size), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("size,options", [(3, {}), (64, {}), (64, {"block_rows": 200})])
def test_sliding_stats_hold_exactly_the_last_values(data, size, options):
    keys, df = data
    found = by_key(scoring.sliding_stats(df, ["k"], "x", ["seq"], size, **options), "stats")
    for k, values in keys.items():
        for i, s in enumerate(found[k]):
            n, mean, m2 = welford(values[max(0, i - size + 1) : i + 1])
            assert s.n == n and s.mean == pytest.approx(mean) and s.m2 == pytest.approx(m2, abs=1e-5)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("options", [{}, {"block_rows": 400}])
def test_scoring_shuffles_the_rows_once(data, options):
    _, df = data
    options = {"size": 100, **options}  # not the scores another test keeps cached
    for scored in (scoring.score(df, ["k"], "x", **options), scoring.score_sliding(df, ["k"], "x", **options)):
        plan = plan_of(scored)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "SortMergeJoin" not in plan and "Python" not in plan


def test_sliding_forgets(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 6)], "k string, seq long, x double")
    last = scoring.sliding_stats(df, ["k"], "x", ["seq"], 3).orderBy(F.desc("seq")).first().stats
    assert (last.n, last.mean) == (3, 4.0)


def test_event_time_order(spark):
    rows = [("a", i, 1000 - i, float(i * i % 17)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, seq long, t long, x double")
    got = [r.zscore for r in scoring.score(df, ["k"], "x", ["t", "seq"]).orderBy("t").collect()]
    assert got == pytest.approx(epoch_scores([r[3] for r in reversed(rows)]), abs=1e-9)


def test_numpy_scoring_in_any_pieces():
    values = np.array(series(1100))
    want = epoch_scores(list(values))
    rng = random.Random(5)
    got, n, mean, m2, at = [], 0, 0.0, 0.0, 0
    while at < len(values):
        step = rng.randrange(1, 260)
        z, n, mean, m2 = score_values(values[at : at + step], n, mean, m2, 200)
        got += list(z)
        at += step
    assert got == pytest.approx(want, rel=1e-6, abs=1e-6)
    assert 0 < n <= 200


@pytest.mark.parametrize("size", [1, 2, 50, 200])
def test_numpy_sliding_in_any_pieces(size):
    values = np.array(series(700))
    rng = random.Random(5)
    got, recent, at = [], np.array([]), 0
    while at < len(values):
        step = rng.randrange(1, 260)
        z, recent = score_recent(values[at : at + step], recent, size)
        got += list(z)
        at += step
    assert got == pytest.approx(sliding_scores(list(values), size), rel=1e-6, abs=1e-6)
    assert len(recent) == size


def test_small_blocks_of_a_null_key_share_tasks(spark):
    """``score`` with 200 blocks of the NULL key keeps its rows' scores and makes no task of each block."""
    rows = spark.range(2000).select("id", F.lit(None).cast("string").alias("k"), (F.col("id") * 7 % 13).cast("double").alias("v"))
    rows = rows.withColumnRenamed("id", "seq")
    small = scoring.score(rows, ["k"], "v", size=10, block_rows=10)
    assert small.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = scoring.score(rows, ["k"], "v", size=10)
    assert sorted(small.collect()) == sorted(whole.collect())


def test_small_blocks_of_sliding_windows_share_tasks(spark):
    """``score_sliding`` with 50 blocks and their halos keeps its rows' scores and makes no task of each block."""
    rows = spark.range(2000).select(F.col("id").alias("seq"), F.lit("a").alias("k"), (F.col("id") * 7 % 13).cast("double").alias("v"))
    small = scoring.score_sliding(rows, ["k"], "v", size=40, block_rows=40)
    assert small.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = scoring.score_sliding(rows, ["k"], "v", size=40)
    assert sorted(r[:4] for r in small.collect()) == sorted(r[:4] for r in whole.collect())
