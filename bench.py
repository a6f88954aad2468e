"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and once more for the time. Results go to a sink that reads every column.
"""

from __future__ import annotations

import json
import os
import time

from tidegauge.plans.catalog import QUERIES
from tidegauge.session import build_session

HEADLINE = [
    "score_ticks",
    "score_sensors",
    "score_sliding_ticks",
    "rollup_ticks_1m",
    "rollup_sensors_1m",
    "recent_price_anomalies",
    "recent_sensor_anomalies",
    "sensor_averages",
    "events_per_second",
    "counter_rate",
    "write_latency_p99",
    "late_flags",
    "fleet_coverage_1h",
    "detector_quality",
    "parse_ticks",
    "parse_sensors",
    "normalise_trades",
    "trailing_rate_1m",
    "rollup_ticks_hopping",
    "stream_score_ticks",
    "stream_tick_pipeline",
]


def timed(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus.replace("*", "8"),
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query = QUERIES[name]
        timed(query, spark, sf_dir)
        times[name] = round(timed(query, spark, sf_dir), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    report = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "rows_per_sec": {n: round(rows / times[n]) for n in ("score_ticks", "score_sensors", "rollup_ticks_1m", "parse_ticks", "stream_score_ticks")},
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
