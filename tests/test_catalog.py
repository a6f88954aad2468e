"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from compare import rows_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_rows_equal_the_sql(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_and_names(spark):
    assert contract.entry(spark).columns == ["time", "symbol", "price", "zscore"]
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_known_counts(spark):
    scored = contract.queries()["score_ticks"](spark, SF_DIR).collect()
    assert sum(r.is_anomaly for r in scored) == 20 and sum(r.zscore == 0 for r in scored) == 15
    sliding = contract.queries()["score_sliding_ticks"](spark, SF_DIR).collect()
    assert sum(r.is_anomaly for r in sliding) == 20
    sensors = contract.queries()["score_sensors"](spark, SF_DIR).collect()
    assert sum(r.is_anomaly for r in sensors) == 26 and len({r.sensor_id for r in sensors}) == 15
    quality = contract.queries()["detector_quality"](spark, SF_DIR).collect()
    assert [sum(r[c] for r in quality) for c in ("tp", "fp", "fn", "tn")] == [12, 14, 3, 971]


PANELS = ("live_price", "tick_throughput", "recent_price_anomalies", "sensor_averages", "machine_anomalies",
          "machine_anomalies_summed", "recent_sensor_anomalies", "ordered_series")


def test_panels_show_events_of_any_month(spark, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path)
    moved = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("ts", F.expr("ts + make_dt_interval(event_id % 3 * 200)"))
    moved.coalesce(1).write.parquet(f"{folder}/events.parquet")
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    for name in PANELS:
        want = db.execute(contract.oracle_sql()[name]).df()
        assert rows_of(contract.queries()[name](spark, folder).toPandas()) == rows_of(want), name
