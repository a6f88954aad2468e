import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.times import time_filter
from tidegauge.plans import panels
from tidegauge.schemas import TICK_RECORD, TICKS
from tidegauge.sources import feeds, tables

NAMES = TICKS.fieldNames()


@pytest.fixture(scope="module")
def ticks(spark):
    """Two thirds of the rows on one date."""
    base = spark.range(3000).withColumn("day", F.when(F.col("id") % 3 > 0, 4).otherwise(F.col("id") % 10))
    return base.select(
        F.timestamp_seconds(1714521600 + F.col("day") * 86400 + F.col("id") * 20).alias("event_time"),
        F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"),
        (F.col("id") % 100).cast("double").alias("price"),
        F.lit(None).cast("double").alias("volume"),
        F.lit(0.5).alias("zscore"),
        (F.col("id") % 50 == 0).alias("is_anomaly"),
    ).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_prunes_dates_and_pushes_the_range(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    tables.write_event_table(ticks, path, ["symbol", "event_time"], files=6)
    table = tables.read_event_table(spark, path, TICKS)
    assert table.count() == 3000
    lo, hi = "2024-05-02 00:00:00", "2024-05-03 12:00:00"
    found = time_filter(table, "event_time", lo, hi)
    want = ticks.where(F.col("event_time").between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
    assert found.select(*NAMES).exceptAll(want).count() == 0 and found.count() == want.count() > 0
    plan = plan_of(found.select("event_time"))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(event_time)" in plan
    assert "ReadSchema: struct<event_time:timestamp>" in plan


def test_latest_rows_are_taken_without_a_full_sort(ticks):
    plan = plan_of(panels.price_anomalies(ticks, "2024-05-01", "2024-06-01", 10))
    assert "TakeOrderedAndProject(limit=10" in plan and "Exchange" not in plan.split("InMemoryRelation")[0]


def test_a_large_date_is_spread_over_files(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    tables.write_event_table(ticks, path, ["symbol", "event_time"], files=6)
    files = spark.read.parquet(path).groupBy("event_date", F.input_file_name().alias("f")).count()
    largest = files.agg(F.max("count")).first()[0]
    assert largest < 900


def test_anomaly_table_holds_the_flagged_rows(spark, ticks, tmp_path):
    path = str(tmp_path / "anomalies")
    tables.write_anomaly_table(ticks, path)
    found = tables.read_event_table(spark, path, TICKS).select(*NAMES)
    assert found.exceptAll(ticks.where("is_anomaly")).count() == 0 and found.count() == 60


def test_a_batch_delivered_twice_counts_once(spark, ticks, tmp_path):
    path = str(tmp_path / "landing")
    for batch in (0, 1, 1, 0):
        tables.append_scored(ticks.where(F.col("price") % 2 == batch), batch, path)
    found = tables.read_event_table(spark, path, TICKS)
    assert found.count() == 3000 and found.select(*NAMES).exceptAll(ticks).count() == 0


def test_topic_round_trip(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = [(i, f"S{i % 4}", float(i), None if i % 5 else 2.5, 1714521600000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, symbol string, price double, volume double, event_time long")
    fields = ["symbol", "price", "volume", "event_time"]
    feeds.write_keyed(df, "symbol", path, "seq", F.timestamp_millis("event_time"), fields)
    stored = spark.read.parquet(path)
    assert stored.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    back = stored.select("offset", F.from_json("value", TICK_RECORD).alias("r")).select("offset", "r.*").collect()
    assert sorted(tuple(r) for r in back) == rows


def test_dead_letters_by_batch(spark, tmp_path):
    path = str(tmp_path / "dead")
    bad = spark.createDataFrame([("x", "bad_json"), ("y", "null_price")], "raw string, reason string")
    when = F.lit(dt.datetime(2024, 5, 1)).cast("timestamp")
    for source, batch in (("ticks", 0), ("ticks", 1), ("ticks", 1), ("sensors", 0)):
        feeds.write_dead_letters(bad, source, when, batch, path)
    found = feeds.read_dead_letters(spark, path)
    assert {(r.source, r.batch_id): r["count"] for r in found.groupBy("source", "batch_id").count().collect()} == {
        ("ticks", 0): 2, ("ticks", 1): 2, ("sensors", 0): 2}


def test_frames_from_text(spark, tmp_path):
    path = str(tmp_path / "frames")
    spark.createDataFrame([('{"type":"ping"}',), ("x",)], "value string").write.text(path)
    assert sorted(r.raw for r in feeds.read_trade_frames(spark, path).collect()) == ["x", '{"type":"ping"}']
    assert feeds.read_trade_frames(spark, path, streaming=True).isStreaming


def test_scratch_follows_the_named_folder(spark):
    from tidegauge.session import scratch_path, shared_root

    named = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_root(spark)
    assert root == named or named is None
    assert scratch_path(spark, "x").startswith(f"{root}/tidegauge/x-")
