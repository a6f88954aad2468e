import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from reference_math import epoch_scores, sliding_scores

from tidegauge.operators import lateness, rollup
from tidegauge.schemas import TICKS
from tidegauge.sources import feeds, tables, versions
from tidegauge.streaming import batches, queries, state
from tidegauge.streaming import late as late_queries

RECORD = "seq long, k string, x double"


def series(n, seed):
    rng = random.Random(seed)
    return [rng.gauss(50, 5) + (60 if i % 83 == 50 else 0) for i in range(n)]


def interleaved():
    """Rows in arrival order; one key has half of them, and one of the keys never changes its value."""
    keys = {"hot": series(1400, 1), "b": series(700, 2), "flat": [0.1] * 500, "few": [1.0, 5.0]}
    slots = [k for k, vs in keys.items() for _ in vs]
    random.Random(4).shuffle(slots)
    nexts = {k: iter(vs) for k, vs in keys.items()}
    return keys, [(i, k, next(nexts[k])) for i, k in enumerate(slots)]


def write_files(spark, rows, folder, parts, schema=RECORD, first=0):
    """Files in arrival order by modification time, with the rows shuffled inside each."""
    os.makedirs(folder, exist_ok=True)
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = rows[i * size : (i + 1) * size]
        random.Random(i).shuffle(part)
        frame = spark.createDataFrame(part, schema).toPandas()
        name = f"{folder}/part-{first + i:03d}.parquet"
        frame.to_parquet(name, index=False)
        stamp = time.time() - 1000 + first + i
        os.utime(name, (stamp, stamp))


@pytest.fixture(scope="module")
def wanted():
    keys, rows = interleaved()
    found = {k: iter(epoch_scores(vs)) for k, vs in keys.items()}
    slid = {k: iter(sliding_scores(vs, 60)) for k, vs in keys.items()}
    return rows, {i: next(found[k]) for i, k, _ in rows}, {i: next(slid[k]) for i, k, _ in rows}


def run_scores(spark, tmp_path, rows, sliding):
    folder, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "check"))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    def run():
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder)
        scored = state.score_stream(stream, ["k"], "x", size=60 if sliding else 200, sliding=sliding)
        queries.start(scored, write, checkpoint, None).awaitTermination()
        return scored.schema

    half = len(rows) // 2
    write_files(spark, rows[:half], folder, 3)
    run()
    # a restart from the checkpoint, in the middle of the epochs
    write_files(spark, rows[half:], folder, 3, first=3)
    schema = run()
    return spark.read.schema(schema).parquet(out).collect()


@pytest.mark.parametrize("sliding", [False, True])
def test_state_store_scores_equal_the_sequential_loop(spark, tmp_path, wanted, sliding):
    rows, epochs, slid = wanted
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = run_scores(spark, tmp_path, rows, sliding)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = slid if sliding else epochs
    assert len(found) == len(rows)
    assert {r.seq: r.zscore for r in found} == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert all(r.is_anomaly == (abs(r.zscore) > 3) for r in found)


@pytest.mark.parametrize("sliding", [False, True])
def test_bucketed_state_scores_equal_the_sequential_loop(spark, tmp_path, wanted, sliding):
    rows, epochs, slid = wanted
    path, out = str(tmp_path / "state"), str(tmp_path / "out")
    run = batches.score_rows(
        late_queries.append_to(out), path, ["k"], "x", size=60 if sliding else 200, sliding=sliding, block_rows=240
    )
    # the hot key is NULL here
    df = spark.createDataFrame([(i, None if k == "hot" else k, x) for i, k, x in rows], RECORD)
    cuts = [0, 900, 1400, 1401, len(rows)]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2 if i == 2 else 1):
            run(df.where(F.col("seq").between(lo, hi - 1)), i)
    found = spark.read.parquet(out).collect()
    assert len(found) == len(rows)
    want = slid if sliding else epochs
    assert {r.seq: r.zscore for r in found} == pytest.approx(want, rel=1e-6, abs=1e-9)
    # the third batch holds one row: it rewrote the bucket of its key only
    runs = versions.commits(spark, path).where("part IS NOT NULL").groupBy("run").count().collect()
    assert {r.run: r["count"] for r in runs}[2] == 1 and len(runs) == 4


def lines(rows):
    out = []
    for i, k, x in rows:
        out.append((k, json.dumps({"symbol": k, "price": x, "event_time": 1714521600000 + i * 1000, "volume": None}), 0, i))
        if i % 40 == 7:
            out.append((k, json.dumps({"symbol": k, "price": "?", "event_time": 1}), 0, 1_000_000 + i))
    return out


def test_pipeline_by_batches(spark, tmp_path, wanted):
    rows, epochs, _ = wanted
    folder, checkpoint = str(tmp_path / "topic"), str(tmp_path / "check")
    folders = batches.Folders(*[str(tmp_path / d) for d in ("table", "dead", "state", "metrics")])
    schema = "key string, value string, partition int, offset long"
    score = batches.score_batches(batches.TICK_FEED, folders, block_rows=200)
    last = {}

    def write(batch, batch_id):
        score(batch, batch_id)
        if batch_id % 2:
            score(batch, batch_id)  # delivered again, as after a failure
        last["id"] = batch_id

    def run():
        stream = feeds.read_events_stream(spark, folder, "parquet", per_trigger=1)
        queries.start(stream, write, checkpoint, None).awaitTermination()

    half = len(rows) // 2
    write_files(spark, lines(rows[:half]), folder, 2, schema)
    run()
    write_files(spark, lines(rows[half:]), folder, 2, schema, first=2)
    run()
    assert last["id"] == 3

    table = tables.read_event_table(spark, folders.table, TICKS)
    found = {round(r.event_time.timestamp() - 1714521600): r for r in table.collect()}
    assert table.count() == len(rows)
    assert {i: r.zscore for i, r in found.items()} == pytest.approx(epochs, rel=1e-6, abs=1e-9)
    dead = feeds.read_dead_letters(spark, folders.dead_letters).collect()
    assert len(dead) == sum(1 for i, _, _ in rows if i % 40 == 7) and {r.reason for r in dead} == {"bad_price"}
    sums = {r.name: r.v for r in spark.read.parquet(folders.metrics).groupBy("name").agg(F.sum("value").alias("v")).collect()}
    assert sums["events"] == len(rows) and sums["dead_letters"] == len(dead)
    assert sums["anomalies"] == sum(abs(z) > 3 for z in epochs.values()) and sums["last_batch_rows"] == len(rows)


def shaped(df):
    return df.select(
        F.timestamp_seconds(1714521600 + F.col("seq") * 7).alias("event_time"),
        F.col("k").alias("symbol"),
        F.col("x").alias("price"),
        (F.col("x") > 90).alias("is_anomaly"),
    )


def same_buckets(found, want):
    key = lambda r: (r.bucket, r.symbol)
    a, b = sorted(found.collect(), key=key), sorted(want.collect(), key=key)
    assert [r[:2] + r[3:] for r in a] == [r[:2] + r[3:] for r in b]
    assert [r.avg_price for r in a] == pytest.approx([r.avg_price for r in b])


def test_stream_rollup_keeps_rows_however_late(spark, tmp_path, wanted):
    rows, _, _ = wanted
    folder, path = str(tmp_path / "in"), str(tmp_path / "rollup")
    # the files come in the wrong order, and each holds rows of the whole time
    shuffled = sorted(rows, key=lambda r: (r[0] * 7919) % 1009)
    write_files(spark, shuffled, folder, 5)
    stream = shaped(spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder))
    fold = queries.fold_rollup(path, ["symbol"], "price")
    queries.start(stream, fold, str(tmp_path / "check"), None).awaitTermination()
    batch = shaped(spark.read.parquet(folder))
    schema, want = queries.summary_schema(batch, ["symbol"]), rollup.rollup_ticks(batch)
    folded = lambda: rollup.tick_buckets(queries.folded(spark, path, schema, ["symbol"]))
    same_buckets(folded(), want)
    # a batch delivered again adds nothing; compacted parts give the same, and later batches come on top
    fold(batch.limit(100), 2)
    queries.compact_rollup(spark, path, schema, ["symbol"], 3)
    same_buckets(folded(), want)
    assert versions.live(spark, path).select("run").distinct().count() == 2
    assert versions.expire(spark, path, 7) > 0
    same_buckets(folded(), want)
    fold(batch.limit(0), 5)
    same_buckets(folded(), want)


def test_late_rows_of_any_cut_equal_the_batch_split(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, f"s{i % 3}" if i % 7 else None, i // 50, 1000 * (i // 50) + rng.randrange(-4000, 1000)) for i in range(1200)]
    schema = "seq long, source string, arrival long, ms long"
    df = spark.createDataFrame(rows, schema)
    want = {}
    for source in {r[1] for r in rows}:
        own = df.where(F.col("source").eqNullSafe(F.lit(source)))
        late = lateness.split_late(own, "arrival", "ms", 1500)[1]
        want |= {r.seq: r.watermark_ms for r in late.collect()}
    assert 100 < len(want) < 1100
    for cuts in ([400, 430, 905], [50 * i for i in range(1, 24, 5)]):
        base = str(tmp_path / f"cut{len(cuts)}")
        run = late_queries.route_late(
            f"{base}/marks", "ms", 1500, late_queries.append_to(f"{base}/good"), late_queries.append_to(f"{base}/late"), "source", "arrival"
        )
        for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 1200])):
            for _ in range(2 if i == 1 else 1):
                run(df.where(F.col("seq").between(lo, hi - 1)), i)
        got = {r.seq: r.watermark_ms for r in spark.read.parquet(f"{base}/late").collect()}
        assert got == want
        good = [r.seq for r in spark.read.parquet(f"{base}/good").collect()]
        assert sorted(good) == [i for i in range(1200) if i not in want]


def test_drain_writes_what_has_arrived(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_files(spark, [(i, "a", float(i)) for i in range(20)], folder, 2)
    seen = []
    stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder)
    flagged = queries.with_counters(stream.withColumn("is_anomaly", F.col("x") > 15), "ticks")
    query = queries.start(flagged, lambda df, i: seen.append(df.count()), str(tmp_path / "check"), 0.1)
    queries.drain(query)
    assert sum(seen) == 20 and not query.isActive
    observed = [p.observedMetrics["ticks"] for p in query.recentProgress if "ticks" in p.observedMetrics]
    assert observed


def test_idle_keys_are_accepted(spark, tmp_path):
    """A query with timeouts has a batch to run at any time, so it is stopped and not drained."""
    folder = str(tmp_path / "in")
    write_files(spark, [(i, "a", float(i % 5)) for i in range(50)], folder, 1)
    stream = spark.readStream.schema(RECORD).parquet(folder)
    rows = []
    scored = state.score_stream(stream, ["k"], "x", idle_ms=60_000)
    query = queries.start(scored, lambda df, i: rows.extend(df.collect()), str(tmp_path / "check"), 0.2)
    until = time.time() + 60
    while len(rows) < 50 and time.time() < until and query.isActive:
        time.sleep(0.2)
    query.stop()
    got = [r.zscore for r in sorted(rows, key=lambda r: r.seq)]
    assert got == pytest.approx(epoch_scores([float(i % 5) for i in range(50)]))
