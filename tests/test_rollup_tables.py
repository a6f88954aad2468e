"""Versioned tables, and rollups refreshed by what was touched and served with a raw tail."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import rollup
from tidegauge.schemas import TICKS_1M
from tidegauge.sources import rollups, tables, versions

T0 = dt.datetime(2024, 5, 1, 10)
RAW = "event_time timestamp, symbol string, price double, is_anomaly boolean"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def ticks(spark, rows):
    return spark.createDataFrame([(at(s), k, float(p), False) for s, k, p in rows], RAW)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_go_by_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], "k string, v long").schema
    versions.create(spark, path, schema)
    put = lambda rows, run, **o: versions.publish(spark.createDataFrame(rows, schema), path, F.col("k"), run, **o)
    get = lambda **o: sorted((r.k, r.v) for r in versions.read(spark, path, schema, **o).collect())
    assert get() == [] and not versions.committed(spark, path, 0)
    put([("a", 1), ("b", 2)], 0)
    put([("a", 3)], 2)
    assert get() == [("a", 1), ("a", 3), ("b", 2)]
    began = versions.read(spark, path, schema)
    # rows of a run that failed before its commit are not seen, and a later try replaces them
    failed = spark.createDataFrame([("a", 9), ("c", 9)], schema).withColumn("part", F.col("k")).withColumn("run", F.lit(4))
    failed.write.mode("append").partitionBy("part", "run").parquet(f"{path}/rows")
    assert get() == [("a", 1), ("a", 3), ("b", 2)] and not versions.committed(spark, path, 4)
    # run 3 replaces what part a held; b is left without rows
    put([("a", 5)], 3, replaces=True, parts=spark.createDataFrame([("a",), ("b",)], "part string"))
    assert get() == [("a", 5)] and get(before=3) == [("a", 1), ("a", 3), ("b", 2)]
    assert sorted((r.k, r.v) for r in began.collect()) == [("a", 1), ("a", 3), ("b", 2)]
    assert versions.expire(spark, path, 3) == 3 and get() == [("a", 5)]
    put([], 5)
    assert versions.committed(spark, path, 5) and get() == [("a", 5)]
    assert get(where=F.col("part") == "x") == []


@pytest.fixture
def stored(spark, tmp_path):
    table = rollups.RollupTable(str(tmp_path / "rollup"), TICKS_1M, rollup.rollup_ticks)
    rollups.create(spark, table)

    def append(rows, entry):
        made = ticks(spark, rows)
        tables.write_event_table(made, str(tmp_path / "raw"), ["event_time"], mode="append")
        rollups.log_touched(made, table, entry)

    def raw():
        return tables.read_event_table(spark, str(tmp_path / "raw"), made_schema)

    made_schema = ticks(spark, [(0, "A", 1)]).schema
    return table, append, raw


def buckets(df):
    return sorted((r.bucket, r.symbol, r.tick_count, r.max_price) for r in df.collect())


def test_old_rows_are_found_without_reading_others(spark, stored, monkeypatch):
    table, append, raw = stored
    day = 86_400
    append([(d * day + s, "A", s) for d in range(-5, 1) for s in range(0, 7200, 600)], "first")
    assert rollups.refresh(raw(), table, 0, at(7260), "1 minute") == 12
    assert buckets(rollups.stored(spark, table)) == buckets(rollup.rollup_ticks(raw()))
    # one late row, three days back: of two hours (its own and the open one), read from two dates
    append([(-3 * day + 60, "B", 7)], "second")
    seen = []
    made = lambda df, width: seen.append(df) or rollup.rollup_ticks(df, width)
    narrow = rollups.RollupTable(table.path, table.schema, made)
    assert rollups.refresh(raw(), narrow, 1, at(7320)) == 2
    files = {f.split("event_date=")[1][:10] for f in seen[0].inputFiles()}
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan_of(seen[0]))
    dates = {str(r[0]) for r in seen[0].select("event_date").distinct().collect()}
    assert dates <= {"2024-04-28", "2024-05-01"} and files
    last = versions.commits(spark, table.path).where("run = 1 AND part IS NOT NULL").select("part").collect()
    assert sorted(r[0] for r in last) == ["2024-04-28", "2024-05-01"]
    assert buckets(rollups.stored(spark, table)) == buckets(rollup.rollup_ticks(raw()))
    # a run is not run twice, and entries are taken once
    assert rollups.refresh(raw(), table, 1, at(9000)) == 0
    assert rollups.refresh(raw(), table, 2, at(7320)) == 1


def test_served_rows_are_stored_below_and_raw_above(spark, stored):
    table, append, raw = stored
    append([(s, k, s) for s in range(-7200, 7200, 45) for k in ("A", "B")], "first")
    lo, hi = "2024-05-01 08:30:30", "2024-05-01 11:30:00"
    want = [b for b in buckets(rollup.rollup_ticks(raw())) if dt.datetime(2024, 5, 1, 8, 30, 30) <= b[0] <= dt.datetime(2024, 5, 1, 11, 30)]
    assert buckets(rollups.served(raw(), table, lo, hi)) == want
    rollups.refresh(raw(), table, 0, at(95))
    assert rollups.reached(spark, table) == at(0).replace(tzinfo=dt.timezone.utc)
    served = rollups.served(raw(), table, lo, hi)
    assert buckets(served) == want
    assert buckets(rollups.served(raw(), table, lo, None)) == [b for b in buckets(rollup.rollup_ticks(raw())) if b[0] >= want[0][0]]
    # both sides are pruned by folders of dates
    plan = plan_of(served)
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan) and re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    # rows that come into a stored hour show after the next refresh
    append([(-3600, "C", 1)], "second")
    assert buckets(rollups.served(raw(), table, lo, hi)) == want
    rollups.refresh(raw(), table, 1, at(95))
    assert len(buckets(rollups.served(raw(), table, lo, hi))) == len(want) + 1


def test_ranges_join_the_nearest_hours(spark):
    hours = [0, 1, 2, 10, 50, 51, 300]
    df = spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in hours], "hour timestamp")
    as_hours = lambda spans: [tuple(int((x.replace(tzinfo=None) - T0).total_seconds()) // 3600 for x in s) for s in spans]
    assert as_hours(rollups.ranges(df)) == [(0, 2), (10, 10), (50, 51), (300, 300)]
    assert as_hours(rollups.ranges(df, 2)) == [(0, 51), (300, 300)]
    assert rollups.ranges(df.limit(0)) == []


def test_hopping_windows_are_merged_from_panes(spark):
    df = ticks(spark, [(s, "AB"[s % 2], (s * 37) % 101) for s in range(0, 4000, 7)])
    made = rollup.rollup_ticks(df, "10 minutes", "2 minutes")
    assert "Expand" not in plan_of(made)
    window = F.window("event_time", "10 minutes", "2 minutes")
    want = df.groupBy(window.start.alias("bucket"), "symbol").agg(F.count("*").alias("tick_count"), F.max("price").alias("max_price"))
    assert buckets(made) == buckets(want)


def table_rows(df):
    return sorted((r.event_time, r.symbol, r.price) for r in df.collect())


def test_compaction_bounds_the_files_and_keeps_every_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "landed")
    day = 86_400
    rows = [(d * day + s, k, s) for d in range(4) for s in range(0, 3600, 30) for k in ("A", "B")]
    for batch in range(6):
        part = ticks(spark, [r for i, r in enumerate(rows) if i % 6 == batch]).repartition(3)
        assert tables.land_scored(part, batch, path)
    # a batch delivered again adds nothing
    assert not tables.land_scored(ticks(spark, rows[:5]), 3, path)
    schema = ticks(spark, rows[:1]).schema
    read = lambda: tables.read_landed(spark, path, schema)
    want = table_rows(ticks(spark, rows))
    assert table_rows(read()) == want
    before = read()
    # a write that fails before its commit leaves the old rows
    with monkeypatch.context() as m:
        real = versions.publish

        def fails(df, *args, **options):
            real(df.where("1 = 0").unionByName(df.limit(3)), str(tmp_path / "elsewhere"), *args[1:], **options)
            raise OSError("lost")

        versions.create(spark, str(tmp_path / "elsewhere"), schema)
        m.setattr(versions, "publish", fails)
        with pytest.raises(OSError):
            tables.compact(spark, path, schema, ["symbol", "event_time"], 4, "2024-05-04", 200)
    assert table_rows(read()) == want
    tables.compact(spark, path, schema, ["symbol", "event_time"], 4, "2024-05-04", 200)
    assert table_rows(read()) == want
    # the reader that was there before still sees its files, until they are expired
    assert table_rows(before) == want
    assert versions.expire(spark, path, 9) == 15
    assert table_rows(read()) == want
    closed = [f for f in spark.read.parquet(f"{path}/rows").inputFiles() if "run=9/" in f]
    # 600 rows of three dates at 200 a file: three files, and one more for each date that a file border cuts
    assert len(closed) <= 3 + 3
    later = read().where(F.col("event_date") == "2024-05-04")
    assert later.count() == 240


def test_keyed_batches_are_written_once(spark, tmp_path):
    from tidegauge.sources import feeds

    path = str(tmp_path / "topic")
    df = ticks(spark, [(i, "AB"[i % 2], i) for i in range(30)]).withColumn("seq", F.col("price").cast("long"))
    write = lambda some, batch: feeds.write_keyed_batch(df.where(some), "symbol", path, "seq", F.col("event_time"), batch, ["symbol", "price"])
    assert write("seq < 10", 0) and not write("seq < 10", 0) and write("seq >= 10", 1) and not write("seq < 30", 1)
    found = feeds.read_keyed(spark, path).collect()
    assert sorted(r.offset for r in found) == list(range(30))
    assert {r.key: r.partition for r in found} == {r.key: r.partition for r in found if r.offset > 20}
