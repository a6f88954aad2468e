"""Every registered query over the event table, each with the SQL that must give the same rows.

Floats are rounded on both sides: averages to nine places, as an average of values with two places
can lie halfway between two numbers of six, the rest to six. Timestamps leave Spark without a zone (UTC).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import stats, times
from ..operators import fleet, health, lateness, loadreport, rollup, scoring, validate
from ..operators.blocks import OWN, POS, ordered_blocks
from ..schemas import SENSOR_READINGS, SENSOR_READINGS_1M, TICK_RECORD, TICKS, TICKS_1M
from ..session import scratch_path
from ..sources import feeds, rollups, tables
from ..streaming import batches, late, progress, queries
from . import panels, views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


AVERAGES = ("base_mean", "mean", "avg_price", "avg_value")


def register(name: str, sql: str | None = None, averages: tuple[str, ...] = AVERAGES) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(query(spark, sf_dir), averages)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def _plain(df: DataFrame, averages: tuple[str, ...]) -> DataFrame:
    """Timestamps without zone, doubles rounded."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 9 if f.name in averages else 6)
        columns.append(c.alias(f.name))
    return df.select(*columns)


# ---- SQL building blocks ----

_TICKS = """ticks AS (
  SELECT event_id AS seq, (epoch_us(ts) // 1000) AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time,
         event_type AS symbol, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""
_NAMES = """named AS (
  SELECT *, machine_id || '-s' || printf('%02d', i) || '-' || sensor_type AS sensor_id FROM (
    SELECT *, printf('machine-%02d', user_id % 5 + 1) AS machine_id,
           ['temperature', 'vibration', 'pressure'][i % 3 + 1] AS sensor_type
    FROM (SELECT *, (epoch_us(ts) // 1000) AS ms, (user_id // 5) % 10 AS i FROM events)))"""
_SENSORS = _NAMES + """, sensors AS (
  SELECT event_id AS seq, make_timestamp(ms * 1000) AS event_time, machine_id, sensor_id, sensor_type,
         value, value >= 200 AS anomaly_injected
  FROM named)"""


def _scored(table: str, key: str, value: str) -> str:
    return f"""scored_{table} AS (
  SELECT * EXCLUDE (epoch, n, mean, sd), zscore, abs(zscore) > 3 AS is_anomaly, n AS base_n, mean AS base_mean, sd AS base_sd
  FROM (SELECT *, CASE WHEN n < 2 OR sd = 0 THEN 0.0 ELSE ({value} - mean) / sd END AS zscore
    FROM (SELECT *, count(*) OVER w AS n, avg({value}) OVER w AS mean, stddev_samp({value}) OVER w AS sd
      FROM (SELECT *, (row_number() OVER (PARTITION BY {key} ORDER BY seq) - 1) // 200 AS epoch FROM {table})
      WINDOW w AS (PARTITION BY {key}, epoch ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))))"""


_SCORED_TICKS = _TICKS + ", " + _scored("ticks", "symbol", "price")
_SCORED_SENSORS = _SENSORS + ", " + _scored("sensors", "sensor_id", "value")


def _ticks_rollup(bucket: str) -> str:
    return f"""SELECT {bucket} AS bucket, symbol, round(avg(price), 9) AS avg_price, max(price) AS max_price,
  min(price) AS min_price, count(*) AS tick_count, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
  FROM scored_ticks GROUP BY ALL"""


def _sensors_rollup(bucket: str) -> str:
    return f"""SELECT {bucket} AS bucket, machine_id, sensor_type, round(avg(value), 9) AS avg_value, max(value) AS max_value,
  round(stddev_samp(value), 6) AS stddev_value, count(*) AS reading_count,
  CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
  FROM scored_sensors GROUP BY ALL"""


_MINUTE = "time_bucket(INTERVAL '1 minute', event_time)"

# ---- scoring ----

_SCORE_TICKS_SQL = f"""WITH {_SCORED_TICKS}
SELECT seq, event_time, symbol, price, volume, round(zscore, 6) AS zscore, is_anomaly FROM scored_ticks"""
_SCORE_SENSORS_SQL = f"""WITH {_SCORED_SENSORS}
SELECT seq, event_time, machine_id, sensor_id, sensor_type, value, anomaly_injected, round(zscore, 6) AS zscore, is_anomaly
FROM scored_sensors"""


def _scored_ticks(spark, sf_dir, **options):
    return scoring.score_ticks(views.ticks(spark, sf_dir), **options)


def _scored_sensors(spark, sf_dir, **options):
    return scoring.score_sensors(views.sensors(spark, sf_dir), **options)


@register("score_ticks", _SCORE_TICKS_SQL)
def score_ticks(spark, sf_dir):
    return _scored_ticks(spark, sf_dir)


@register("score_sensors", _SCORE_SENSORS_SQL)
def score_sensors(spark, sf_dir):
    return _scored_sensors(spark, sf_dir)


@register("score_ticks_split_keys", _SCORE_TICKS_SQL)
def score_ticks_split_keys(spark, sf_dir):
    """The same with each symbol split into blocks, the way it runs where keys are large."""
    return _scored_ticks(spark, sf_dir, block_rows=400)


_BASELINE_SQL = f"""WITH {_SCORED_TICKS}
SELECT seq, symbol, price, base_n, round(base_mean, 9) AS base_mean, round(base_sd, 6) AS base_sd FROM scored_ticks"""


@register("epoch_baseline", _BASELINE_SQL)
def epoch_baseline(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).select("seq", "symbol", "price")
    return scoring.epoch_baseline(rows, ["symbol"], "price", ["seq"])


@register("epoch_baseline_by_event_time", _BASELINE_SQL)
def epoch_baseline_by_event_time(spark, sf_dir):
    """In event-time order, with split keys; the events come in that order, so the rows are the same."""
    rows = views.ticks(spark, sf_dir).select("seq", "event_time", "symbol", "price")
    based = scoring.epoch_baseline(rows, ["symbol"], "price", ["event_time", "seq"], block_rows=600)
    return based.drop("event_time")


@register(
    "zscore_of_value",
    f"WITH {_SCORED_SENSORS} SELECT seq, round(zscore, 6) AS zscore FROM scored_sensors",
)
def zscore_of_value(spark, sf_dir):
    rows = scoring.epoch_baseline(views.sensors(spark, sf_dir), ["sensor_id"], "value", ["seq"])
    z = stats.zscore(F.col("value"), F.col("base_n"), F.col("base_mean"), F.col("base_sd"))
    return rows.select("seq", z.alias("zscore"))


@register(
    "anomaly_flags",
    f"""WITH {_SCORED_SENSORS} SELECT seq, abs(zscore) > 3 AS beyond_3, abs(zscore) > 2 AS beyond_2 FROM scored_sensors""",
)
def anomaly_flags(spark, sf_dir):
    z = F.col("zscore")
    return _scored_sensors(spark, sf_dir).select(
        "seq", stats.is_anomaly(z).alias("beyond_3"), stats.is_anomaly(z, 2.0).alias("beyond_2")
    )


def _sliding_sql(tables: str, table: str, key: str, value: str, frame: str, out: str) -> str:
    return f"""WITH {tables}, framed AS (
  SELECT *, count(*) OVER w AS n, avg({value}) OVER w AS mean, stddev_samp({value}) OVER w AS sd
  FROM {table} WINDOW w AS (PARTITION BY {key} ORDER BY seq ROWS BETWEEN {frame}))
SELECT {out} FROM framed"""


_Z = "CASE WHEN n < 2 OR sd = 0 THEN 0.0 ELSE ({v} - mean) / sd END"


@register(
    "sliding_stats",
    _sliding_sql(
        _TICKS, "ticks", "symbol", "price", "199 PRECEDING AND CURRENT ROW",
        "seq, symbol, price, n AS count, round(mean, 9) AS mean, round(coalesce(sd, 0), 6) AS stddev",
    ),
)
def sliding_stats(spark, sf_dir, size=200, **options):
    rows = views.ticks(spark, sf_dir).select("seq", "symbol", "price")
    found = scoring.sliding_stats(rows, ["symbol"], "price", ["seq"], size, **options)
    s = F.col("stats")
    return found.select(
        *rows.columns, s["n"].alias("count"), s["mean"].alias("mean"), stats.stddev(s).alias("stddev")
    )


@register(
    "sliding_stats_short",
    _sliding_sql(
        _TICKS, "ticks", "symbol", "price", "9 PRECEDING AND CURRENT ROW",
        "seq, symbol, price, n AS count, round(mean, 9) AS mean, round(coalesce(sd, 0), 6) AS stddev",
    ),
)
def sliding_stats_short(spark, sf_dir):
    return sliding_stats(spark, sf_dir, size=10, block_rows=500)


_SLIDING_TICKS_SQL = _sliding_sql(
    _TICKS, "ticks", "symbol", "price", "200 PRECEDING AND 1 PRECEDING",
    f"seq, symbol, price, round({_Z.format(v='price')}, 6) AS zscore, abs({_Z.format(v='price')}) > 3 AS is_anomaly",
)


@register("score_sliding_ticks", _SLIDING_TICKS_SQL)
def score_sliding_ticks(spark, sf_dir, **options):
    rows = views.ticks(spark, sf_dir).select("seq", "symbol", "price")
    return scoring.score_sliding(rows, ["symbol"], "price", **options)


@register("score_sliding_split_keys", _SLIDING_TICKS_SQL)
def score_sliding_split_keys(spark, sf_dir):
    return score_sliding_ticks(spark, sf_dir, block_rows=600)


@register(
    "score_sliding_sensors",
    _sliding_sql(
        _SENSORS, "sensors", "sensor_id", "value", "200 PRECEDING AND 1 PRECEDING",
        f"seq, sensor_id, value, round({_Z.format(v='value')}, 6) AS zscore, abs({_Z.format(v='value')}) > 3 AS is_anomaly",
    ),
)
def score_sliding_sensors(spark, sf_dir):
    rows = views.sensors(spark, sf_dir).select("seq", "sensor_id", "value")
    return scoring.score_sliding(rows, ["sensor_id"], "value")


_SUMMARY_SQL = """SELECT symbol, count(*) AS count, round(avg(price), 9) AS mean, round(var_samp(price) * (count(*) - 1), 3) AS m2,
  min(price) AS lo, max(price) AS hi, round(var_samp(price), 6) AS variance, round(stddev_samp(price), 6) AS stddev FROM ticks GROUP BY symbol"""


@register("running_stats", f"WITH {_TICKS} {_SUMMARY_SQL}")
def running_stats(spark, sf_dir):
    found = scoring.running_stats(views.ticks(spark, sf_dir), ["symbol"], "price")
    return found.withColumn("m2", F.round("m2", 3))


@register("merge_stats", f"WITH {_TICKS} {_SUMMARY_SQL}")
def merge_stats(spark, sf_dir):
    """Summaries of two halves of the events, merged."""
    rows = views.ticks(spark, sf_dir)
    low, high = rows.where("price < 50"), rows.where("price >= 50")
    merged = scoring.merge_summaries(
        scoring.running_stats(low, ["symbol"], "price"),
        scoring.running_stats(high, ["symbol"], "price"),
        ["symbol"],
    )
    return merged.withColumn("m2", F.round("m2", 3))


@register(
    "merge_stats_flat",
    """SELECT CASE WHEN event_type <> 'view' THEN event_type END AS symbol, count(*) AS count, 0.1 AS mean, 0.0 AS variance, 0.0 AS stddev
FROM events GROUP BY ALL""",
)
def merge_stats_flat(spark, sf_dir):
    """Parts of a flat series, stored and merged, have no spread; the NULL symbol is one like any other."""
    rows = views.ticks(spark, sf_dir).select(
        "seq", F.when(F.col("symbol") != "view", F.col("symbol")).alias("symbol"), F.lit(0.1).alias("price")
    )
    parts = [scoring.running_stats(rows.where(F.col("seq") % 3 == i), ["symbol"], "price") for i in range(3)]
    merged = scoring.merge_summaries(scoring.merge_summaries(parts[0], parts[1], ["symbol"]), parts[2], ["symbol"])
    return merged.select("symbol", "count", "mean", "variance", "stddev")


# The NULL symbol is a key, and rows without an order come first.
_UNSET_SQL = """ticks AS (SELECT event_id AS seq, CASE WHEN event_type <> 'view' THEN event_type END AS symbol, value AS price,
  CASE WHEN event_id % 500 <> 7 OR event_type = 'view' THEN event_id END AS place FROM events)"""


@register(
    "score_unset_keys",
    f"""WITH {_UNSET_SQL}, {_scored('ticks', 'symbol', 'price')}
SELECT seq, symbol, price, round(zscore, 6) AS zscore, is_anomaly FROM scored_ticks""",
)
def score_unset_keys(spark, sf_dir):
    """The NULL symbol holds more rows than a block."""
    rows = views.ticks(spark, sf_dir).select(
        "seq", F.when(F.col("symbol") != "view", F.col("symbol")).alias("symbol"), "price"
    )
    return scoring.score(rows, ["symbol"], "price", block_rows=200)


@register(
    "positions_with_unset_order",
    f"""WITH {_UNSET_SQL} SELECT symbol, coalesce(place, -1) AS place,
  row_number() OVER (PARTITION BY symbol ORDER BY place NULLS FIRST) - 1 AS at FROM ticks""",
)
def positions_with_unset_order(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).select(
        "seq",
        F.when(F.col("symbol") != "view", F.col("symbol")).alias("symbol"),
        F.when((F.col("seq") % 500 != 7) | (F.col("symbol") == "view"), F.col("seq")).alias("place"),
    )
    placed = ordered_blocks(rows, ["symbol"], ["place"], block_rows=200, halo=10)
    return placed.where(OWN).select("symbol", F.coalesce("place", F.lit(-1)).alias("place"), F.col(POS).alias("at"))


# ---- lateness ----


def _late_sql(allowed_ms: int, columns: str, where: str = "") -> str:
    return f"""WITH arrivals AS (
  SELECT event_id AS seq, (epoch_us(ts) // 1000) AS ms, ((epoch_us(ts) // 1000) + (event_id * 7919 % 97) * 60000) // 3600000 AS batch FROM events),
tops AS (SELECT batch, max(ms) AS top FROM arrivals GROUP BY batch),
marks AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_ms FROM tops),
marked AS (SELECT seq, ms, batch, watermark_ms, coalesce(ms < watermark_ms - {allowed_ms}, false) AS late FROM arrivals JOIN marks USING (batch))
SELECT {columns} FROM marked {where}"""


@register("late_flags", _late_sql(5000, "seq, ms, batch, coalesce(watermark_ms, -1) AS watermark_ms, late"))
def late_flags(spark, sf_dir):
    rows = views.arrivals(spark, sf_dir).select("seq", "ms", "batch")
    marked = lateness.mark_late(rows, "batch", "ms", 5000)
    return marked.withColumn("watermark_ms", F.coalesce("watermark_ms", F.lit(-1)))


@register("late_rows", _late_sql(600000, "seq, ms, batch, watermark_ms", "WHERE late"))
def late_rows(spark, sf_dir):
    rows = views.arrivals(spark, sf_dir).select("seq", "ms", "batch")
    return lateness.split_late(rows, "batch", "ms", 600000)[1]


@register("on_time_rows", _late_sql(600000, "seq, ms, batch", "WHERE NOT late"))
def on_time_rows(spark, sf_dir):
    rows = views.arrivals(spark, sf_dir).select("seq", "ms", "batch")
    return lateness.split_late(rows, "batch", "ms", 600000)[0]


# ---- rollups ----


@register("rollup_ticks_1m", f"WITH {_SCORED_TICKS} {_ticks_rollup(_MINUTE)}")
def rollup_ticks_1m(spark, sf_dir):
    return rollup.rollup_ticks(_scored_ticks(spark, sf_dir))


@register("rollup_ticks_1h", f"""WITH {_SCORED_TICKS} {_ticks_rollup("date_trunc('hour', event_time)")}""")
def rollup_ticks_1h(spark, sf_dir):
    return rollup.rollup_ticks(_scored_ticks(spark, sf_dir), "1 hour")


@register("rollup_sensors_1m", f"WITH {_SCORED_SENSORS} {_sensors_rollup(_MINUTE)}")
def rollup_sensors_1m(spark, sf_dir):
    return rollup.rollup_sensors(_scored_sensors(spark, sf_dir))


@register(
    "rollup_sensors_1d",
    f"WITH {_SCORED_SENSORS} {_sensors_rollup('CAST(CAST(event_time AS DATE) AS TIMESTAMP)')}",
)
def rollup_sensors_1d(spark, sf_dir):
    return rollup.rollup_sensors(_scored_sensors(spark, sf_dir), "1 day")


@register(
    "rollup_ticks_hopping",
    f"""WITH {_SCORED_TICKS}, hops AS (
  SELECT scored_ticks.*, time_bucket(INTERVAL '15 minutes', event_time) - h.h * INTERVAL '15 minutes' AS start
  FROM scored_ticks, (SELECT unnest([0, 1, 2, 3]) AS h) h)
{_ticks_rollup("start").replace("FROM scored_ticks", "FROM hops")}""",
)
def rollup_ticks_hopping(spark, sf_dir):
    return rollup.rollup_ticks(_scored_ticks(spark, sf_dir), "1 hour", "15 minutes")


@register(
    "rollup_sensors_hopping",
    f"""WITH {_SCORED_SENSORS}, hops AS (
  SELECT scored_sensors.*, time_bucket(INTERVAL '30 minutes', event_time) - h.h * INTERVAL '30 minutes' AS start
  FROM scored_sensors, (SELECT unnest([0, 1]) AS h) h)
{_sensors_rollup("start").replace("FROM scored_sensors", "FROM hops")}""",
)
def rollup_sensors_hopping(spark, sf_dir):
    return rollup.rollup_sensors(_scored_sensors(spark, sf_dir), "1 hour", "30 minutes")


@register(
    "time_buckets",
    f"""WITH {_TICKS} SELECT seq, {_MINUTE} AS minute, time_bucket(INTERVAL '7 minutes', event_time) AS seven_minutes,
  time_bucket(INTERVAL '1 day', event_time) AS day, time_bucket(INTERVAL '7 days', event_time) AS week FROM ticks""",
)
def time_buckets(spark, sf_dir):
    # one window per projection
    rows = views.ticks(spark, sf_dir).select("seq", "event_time")
    widths = {"minute": "1 minute", "seven_minutes": "7 minutes", "day": "1 day", "week": "7 days"}
    for name, width in widths.items():
        rows = rows.withColumn(name, times.time_bucket(width, F.col("event_time")))
    return rows.drop("event_time")


_REFRESHES = [dt.datetime(2024, 1, 12, 6, 30, 20), dt.datetime(2024, 1, 20, 18, 4, 10)]


def _refreshed_sql(select: str, tables: str) -> str:
    return f"""WITH {tables}, everything AS ({select})
SELECT * FROM everything
WHERE bucket + INTERVAL '1 minute' <= TIMESTAMP '2024-01-12 06:29:20'
   OR (bucket >= TIMESTAMP '2024-01-18 18:04:10' AND bucket + INTERVAL '1 minute' <= TIMESTAMP '2024-01-20 18:03:10')"""


def _refreshed(spark, raw, make, schema):
    """A rollup filled up to one point in time, then refreshed over the two days before another."""
    path = scratch_path(spark, "rollup-table")
    rollup.create_rollup(spark, path, schema)
    rollup.refresh_rollup(raw, make, path, schema, _REFRESHES[0], full=True)
    rollup.refresh_rollup(raw, make, path, schema, _REFRESHES[1], start_offset="2 days")
    return rollup.read_rollup(spark, path, schema).drop(rollup.PARTITION)


@register("refresh_ticks_rollup", _refreshed_sql(_ticks_rollup(_MINUTE), _SCORED_TICKS))
def refresh_ticks_rollup(spark, sf_dir):
    return _refreshed(spark, _scored_ticks(spark, sf_dir), rollup.rollup_ticks, TICKS_1M)


@register("refresh_sensors_rollup", _refreshed_sql(_sensors_rollup(_MINUTE), _SCORED_SENSORS))
def refresh_sensors_rollup(spark, sf_dir):
    return _refreshed(spark, _scored_sensors(spark, sf_dir), rollup.rollup_sensors, SENSOR_READINGS_1M)


# ---- fleet ----


@register(
    "sensor_dimension",
    f"""WITH {_NAMES}, machines AS (SELECT DISTINCT machine_id FROM named)
SELECT machine_id, machine_id || '-s' || printf('%02d', i) || '-' || t AS sensor_id, t AS sensor_type, i AS sensor_index
FROM (SELECT machine_id, i, ['temperature', 'vibration', 'pressure'][i % 3 + 1] AS t
      FROM machines, (SELECT CAST(unnest(generate_series(0, 9)) AS INTEGER) AS i))""",
)
def sensor_dimension(spark, sf_dir):
    return fleet.sensor_dimension(views.sensors(spark, sf_dir).select("machine_id").distinct())


def _coverage_sql(bucket: str) -> str:
    return f"""WITH {_SENSORS}, machines AS (SELECT DISTINCT machine_id FROM named),
dim AS (SELECT machine_id, machine_id || '-s' || printf('%02d', i) || '-' || t AS sensor_id, t AS sensor_type
  FROM (SELECT machine_id, i, ['temperature', 'vibration', 'pressure'][i % 3 + 1] AS t
        FROM machines, (SELECT unnest(generate_series(0, 9)) AS i))),
seen AS (SELECT DISTINCT {bucket} AS bucket, sensor_id FROM sensors)
SELECT bucket, machine_id, sensor_id, sensor_type FROM (SELECT DISTINCT bucket FROM seen), dim
WHERE (bucket, sensor_id) NOT IN (SELECT (bucket, sensor_id) FROM seen)"""


def _coverage(spark, sf_dir, width):
    readings = views.sensors(spark, sf_dir)
    dimension = fleet.sensor_dimension(readings.select("machine_id").distinct())
    return fleet.fleet_coverage(readings, dimension, width)


@register("fleet_coverage_1d", _coverage_sql("CAST(CAST(event_time AS DATE) AS TIMESTAMP)"))
def fleet_coverage_1d(spark, sf_dir):
    return _coverage(spark, sf_dir, "1 day")


@register("fleet_coverage_1h", _coverage_sql("date_trunc('hour', event_time)"))
def fleet_coverage_1h(spark, sf_dir):
    return _coverage(spark, sf_dir, "1 hour")


@register(
    "detector_quality",
    f"""WITH {_SCORED_SENSORS}, c AS (
  SELECT sensor_type, CAST(sum(CASE WHEN is_anomaly AND anomaly_injected THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN is_anomaly AND NOT anomaly_injected THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN NOT is_anomaly AND anomaly_injected THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(sum(CASE WHEN NOT is_anomaly AND NOT anomaly_injected THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM scored_sensors GROUP BY sensor_type)
SELECT *, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM c""",
)
def detector_quality(spark, sf_dir):
    return fleet.detector_quality(_scored_sensors(spark, sf_dir))


# ---- validation ----

_LINE_PARTS = """SELECT event_id AS seq, event_type, value, (epoch_us(ts) // 1000) AS ms,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS p, json_extract_string(props, '$.k') AS k FROM events"""


def _lines_sql(line: str, parts: str = _LINE_PARTS) -> str:
    text = line.replace("{text}", "VARCHAR")
    return f"lines AS (SELECT seq, {text.replace('event_id', 'seq')} AS raw FROM ({parts})), docs AS (SELECT seq, raw, TRY_CAST(raw AS JSON) AS j FROM lines)"


def _text_reason(name: str, j: str = "j", key: str | None = None) -> str:
    at = f"{j}, '$.{key or name}'"
    return f"""WHEN NOT json_exists({at}) THEN 'missing_{name}' WHEN json_type({at}) = 'NULL' THEN 'null_{name}'
  WHEN json_type({at}) <> 'VARCHAR' THEN 'bad_{name}'"""


def _float(key: str, j: str = "j") -> str:
    return f"TRY_CAST(json_extract_string({j}, '$.{key}') AS DOUBLE)"


def _float_reason(name: str, j: str = "j", key: str | None = None) -> str:
    at = f"{j}, '$.{key or name}'"
    x = _float(key or name, j)
    return f"""WHEN NOT json_exists({at}) THEN 'missing_{name}' WHEN json_type({at}) = 'NULL' THEN 'null_{name}'
  WHEN {x} IS NULL THEN 'bad_{name}' WHEN NOT isfinite({x}) THEN 'non_finite'"""


def _int(key: str, j: str = "j") -> str:
    text = f"json_extract_string({j}, '$.{key}')"
    return f"""CASE WHEN json_type({j}, '$.{key}') = 'VARCHAR'
    THEN CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+') THEN CAST({text} AS BIGINT) END
    ELSE CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS BIGINT) END"""


def _int_reason(name: str, j: str = "j", key: str | None = None) -> str:
    at = f"{j}, '$.{key or name}'"
    return f"""WHEN NOT json_exists({at}) THEN 'missing_{name}' WHEN json_type({at}) = 'NULL' THEN 'null_{name}'
  WHEN {_int(key or name, j)} IS NULL THEN 'bad_{name}'"""


_DOCUMENT = "CASE WHEN j IS NULL THEN 'bad_json' WHEN json_type(j) <> 'OBJECT' THEN 'not_object'"
_TICK_CHECKED = f"""{_lines_sql(views.TICK_LINE)}, checked AS (
  SELECT *, {_DOCUMENT} {_text_reason('symbol')} {_float_reason('price')} {_int_reason('event_time')}
    WHEN json_exists(j, '$.volume') AND json_type(j, '$.volume') <> 'NULL' AND {_float('volume')} IS NULL THEN 'bad_volume'
  END AS reason FROM docs),
good_ticks AS (SELECT seq, json_extract_string(j, '$.symbol') AS symbol, {_float('price')} AS price,
    CASE WHEN NOT json_exists(j, '$.volume') THEN 0.0 ELSE {_float('volume')} END AS volume, {_int('event_time')} AS event_time
  FROM checked WHERE reason IS NULL)"""


@register("parse_ticks", f"WITH {_TICK_CHECKED} SELECT * FROM good_ticks")
def parse_ticks(spark, sf_dir):
    return validate.parse_ticks(views.tick_lines(spark, sf_dir))[0]


@register("reject_ticks", f"WITH {_TICK_CHECKED} SELECT seq, raw, reason FROM checked WHERE reason IS NOT NULL")
def reject_ticks(spark, sf_dir):
    return validate.parse_ticks(views.tick_lines(spark, sf_dir))[1]


_SENSOR_PARTS = "SELECT *, event_id AS seq, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS p FROM named"
_SENSOR_CHECKED = f"""{_NAMES}, {_lines_sql(views.SENSOR_LINE, _SENSOR_PARTS)}, checked AS (
  SELECT *, {_DOCUMENT} {_text_reason('machine_id')} {_text_reason('sensor_id')} {_text_reason('sensor_type')}
    {_float_reason('value')} {_int_reason('event_time')} END AS reason FROM docs)"""


@register(
    "parse_sensors",
    f"""WITH {_SENSOR_CHECKED} SELECT seq, json_extract_string(j, '$.machine_id') AS machine_id,
  json_extract_string(j, '$.sensor_id') AS sensor_id, json_extract_string(j, '$.sensor_type') AS sensor_type,
  {_float('value')} AS value, {_int('event_time')} AS event_time, json_exists(j, '$.anomaly_injected') AS labelled,
  coalesce(CAST(json_extract(j, '$.anomaly_injected') AS BOOLEAN), false) AS anomaly_injected
FROM checked WHERE reason IS NULL""",
)
def parse_sensors(spark, sf_dir):
    good = validate.parse_sensors(views.sensor_lines(spark, sf_dir))[0]
    label = F.col("anomaly_injected")
    return good.withColumn("labelled", label.isNotNull()).withColumn("anomaly_injected", F.coalesce(label, F.lit(False)))


@register("reject_sensors", f"WITH {_SENSOR_CHECKED} SELECT seq, raw, reason FROM checked WHERE reason IS NOT NULL")
def reject_sensors(spark, sf_dir):
    return validate.parse_sensors(views.sensor_lines(spark, sf_dir))[1]


_FRAMES = f"""{_lines_sql(views.FRAME_LINE)}, frames AS (SELECT *, {_DOCUMENT} END AS reason FROM docs),
trade_frames AS (SELECT *, json_exists(j, '$.data') AND json_type(j, '$.data') <> 'ARRAY' AS bad_data FROM frames
  WHERE reason IS NULL AND json_extract_string(j, '$.type') = 'trade'),
trades AS (SELECT seq, i AS trade_index, json_extract(j, '$.data[' || i || ']') AS t FROM (
  SELECT seq, j, CAST(unnest(generate_series(0, CAST(json_array_length(j, '$.data') AS BIGINT) - 1)) AS INTEGER) AS i
  FROM trade_frames WHERE NOT bad_data AND json_exists(j, '$.data'))),
checked AS (SELECT *, CASE WHEN json_type(t) <> 'OBJECT' THEN 'not_object' {_text_reason('symbol', 't', 's')}
  {_float_reason('price', 't', 'p')} WHEN json_exists(t, '$.v') AND json_type(t, '$.v') = 'NULL' THEN 'null_volume'
  WHEN json_exists(t, '$.v') AND {_float('v', 't')} IS NULL THEN 'bad_volume' {_int_reason('event_time', 't', 't')} END AS reason FROM trades)"""


@register("parse_frames", f"WITH {_FRAMES} SELECT seq, raw, reason FROM frames")
def parse_frames(spark, sf_dir):
    return validate.check_frames(views.frame_lines(spark, sf_dir)).drop("frame")


@register("only_trades", f"WITH {_FRAMES} SELECT seq, raw FROM trade_frames")
def only_trades(spark, sf_dir):
    good, _ = validate.parse_frames(views.frame_lines(spark, sf_dir))
    return validate.only_trades(good).drop("frame")


@register("explode_trades", f"WITH {_FRAMES} SELECT seq, trade_index, json_type(t) = 'OBJECT' AS is_object FROM trades")
def explode_trades(spark, sf_dir):
    good, _ = validate.parse_frames(views.frame_lines(spark, sf_dir))
    rows, _ = validate.explode_trades(validate.only_trades(good))
    kind = F.schema_of_variant("trade").startswith("OBJECT")
    return rows.select("seq", "trade_index", kind.alias("is_object"))


@register(
    "normalise_trades",
    f"""WITH {_FRAMES} SELECT seq, trade_index, json_extract_string(t, '$.s') AS symbol, {_float('p', 't')} AS price,
  CASE WHEN NOT json_exists(t, '$.v') THEN 0.0 ELSE {_float('v', 't')} END AS volume, {_int('t', 't')} AS event_time
FROM checked WHERE reason IS NULL""",
)
def normalise_trades(spark, sf_dir):
    return validate.trades_of_frames(views.frame_lines(spark, sf_dir))[0]


@register(
    "reject_trades",
    f"""WITH {_FRAMES} SELECT seq, CAST(-1 AS INTEGER) AS trade_index, reason FROM frames WHERE reason IS NOT NULL
UNION ALL SELECT seq, -1, 'bad_data' FROM trade_frames WHERE bad_data
UNION ALL SELECT seq, trade_index, reason FROM checked WHERE reason IS NOT NULL""",
)
def reject_trades(spark, sf_dir):
    """Faulty frames have the index -1."""
    bad = validate.trades_of_frames(views.frame_lines(spark, sf_dir))[1]
    return bad.select("seq", F.coalesce("trade_index", F.lit(-1)).alias("trade_index"), "reason")


@register(
    "event_timestamps",
    "SELECT event_id AS seq, make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time, (epoch_us(ts) // 1000) AS event_ms FROM events",
)
def event_timestamps(spark, sf_dir):
    rows = views.events(spark, sf_dir)
    at = times.to_event_ts(F.col("ms"))
    return rows.select(F.col("event_id").alias("seq"), at.alias("event_time"), F.unix_millis(at).alias("event_ms"))


@register(
    "not_null_rows",
    f"""WITH {_TICK_CHECKED} SELECT seq, CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.symbol') = 'VARCHAR' THEN json_extract_string(j, '$.symbol') END AS symbol
FROM checked WHERE j IS NOT NULL AND json_type(j) = 'OBJECT' AND json_type(j, '$.symbol') = 'VARCHAR'
  AND {_float('price')} IS NOT NULL AND json_exists(j, '$.event_time') AND {_int('event_time')} IS NOT NULL""",
)
def not_null_rows(spark, sf_dir):
    checked = validate.check_ticks(views.tick_lines(spark, sf_dir)).drop("reason")
    return validate.enforce_not_null(checked, ["symbol", "price", "event_time"])[0].select("seq", "symbol")


@register(
    "not_null_reasons",
    f"""WITH {_TICK_CHECKED}, v AS (SELECT seq, CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.symbol') = 'VARCHAR' THEN 1 END AS s,
  CASE WHEN json_type(j) = 'OBJECT' THEN {_float('price')} END AS p, CASE WHEN json_type(j) = 'OBJECT' THEN {_int('event_time')} END AS e FROM checked)
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN s IS NULL THEN 'null_symbol' WHEN p IS NULL THEN 'null_price' WHEN e IS NULL THEN 'null_event_time' END AS reason FROM v)
WHERE reason IS NOT NULL GROUP BY reason""",
)
def not_null_reasons(spark, sf_dir):
    checked = validate.check_ticks(views.tick_lines(spark, sf_dir)).drop("reason")
    bad = validate.enforce_not_null(checked, ["symbol", "price", "event_time"])[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- tables, keyed records, dead letters ----


@register(
    "keyed_records",
    f"WITH {_TICKS} SELECT symbol AS key, symbol, price, volume, ms AS event_time, seq AS record_offset FROM ticks",
)
def keyed_records(spark, sf_dir):
    """Written as a topic and read back from it."""
    path = scratch_path(spark, "topic")
    rows = views.ticks(spark, sf_dir).withColumn("event_ms", F.unix_millis("event_time"))
    rows = rows.select("seq", "symbol", "price", "volume", F.col("event_ms").alias("event_time"))
    fields = ["symbol", "price", "volume", "event_time"]
    feeds.write_keyed(rows, "symbol", path, "seq", times.to_event_ts(F.col("event_time")), fields)
    record = F.from_json("value", TICK_RECORD)
    return spark.read.parquet(path).select(
        "key", record.alias("r"), F.col("offset").alias("record_offset")
    ).select("key", "r.*", "record_offset")


@register(
    "dead_letters",
    f"WITH {_TICK_CHECKED} SELECT 'ticks' AS source, raw, reason, count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY ALL",
)
def dead_letters(spark, sf_dir):
    """Written twice under one batch id: the second write replaces the first."""
    path = scratch_path(spark, "dead-letters")
    bad = validate.parse_ticks(views.tick_lines(spark, sf_dir))[1]
    for _ in range(2):
        feeds.write_dead_letters(bad, "ticks", F.current_timestamp(), 0, path)
    stored = feeds.read_dead_letters(spark, path)
    return stored.groupBy("source", "raw", "reason").agg(F.count(F.lit(1)).alias("n"))


_TICK_ROWS_SQL = f"WITH {_SCORED_TICKS} SELECT event_time, symbol, price, volume, round(zscore, 6) AS zscore, is_anomaly FROM scored_ticks"


@register("append_scored", _TICK_ROWS_SQL)
def append_scored(spark, sf_dir):
    """Three batches by id, one of them delivered twice."""
    path = scratch_path(spark, "landing")
    scored = _scored_ticks(spark, sf_dir)
    for batch in (0, 1, 1, 2):
        rows = scored.where(F.col("seq") % 3 == batch).select(*TICKS.fieldNames())
        tables.append_scored(rows, batch, path)
    return tables.read_event_table(spark, path, TICKS).select(*TICKS.fieldNames())


@register(
    "event_table_range",
    _TICK_ROWS_SQL + " WHERE event_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-25 18:00:00'",
)
def event_table_range(spark, sf_dir):
    path = scratch_path(spark, "ticks-table")
    tables.write_event_table(_scored_ticks(spark, sf_dir).drop("seq"), path, ["symbol", "event_time"])
    table = tables.read_event_table(spark, path, TICKS)
    return times.time_filter(table, "event_time", "2024-01-05 06:00:00", "2024-01-25 18:00:00").drop(tables.DATE)


@register("keyed_records_once", f"WITH {_TICKS} SELECT symbol AS key, symbol, price, volume, ms AS event_time, seq AS record_offset FROM ticks")
def keyed_records_once(spark, sf_dir):
    """Three batches, one delivered twice, one after it had failed before its commit."""
    path = scratch_path(spark, "topic")
    rows = views.ticks(spark, sf_dir).withColumn("event_time", F.unix_millis("event_time"))
    fields = ["symbol", "price", "volume", "event_time"]
    at = times.to_event_ts(F.col("event_time"))
    for batch in (0, 1, 1, 2):
        part = rows.where(F.col("seq") % 3 == batch)
        feeds.write_keyed_batch(part, "symbol", path, "seq", at, batch, fields)
    record = F.from_json("value", TICK_RECORD).alias("r")
    found = feeds.read_keyed(spark, path).select("key", record, F.col("offset").alias("record_offset"))
    return found.select("key", "r.*", "record_offset")


@register(
    "compacted_table",
    _TICK_ROWS_SQL + " WHERE event_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-25 18:00:00'",
)
def compacted_table(spark, sf_dir):
    """Landed in three batches, of which the closed dates are compacted after the second."""
    path = scratch_path(spark, "landed")
    scored = _scored_ticks(spark, sf_dir)
    for batch in range(3):
        tables.land_scored(scored.where(F.col("seq") % 3 == batch).select(*TICKS.fieldNames()), batch, path)
        if batch == 1:
            tables.compact(spark, path, TICKS, ["symbol", "event_time"], batch, "2024-01-15")
    table = tables.read_landed(spark, path, TICKS)
    return times.time_filter(table, "event_time", "2024-01-05 06:00:00", "2024-01-25 18:00:00").drop(tables.DATE)


@register("anomaly_table", _TICK_ROWS_SQL + " WHERE is_anomaly")
def anomaly_table(spark, sf_dir):
    path = scratch_path(spark, "anomalies")
    tables.write_anomaly_table(_scored_ticks(spark, sf_dir).drop("seq"), path)
    return tables.read_event_table(spark, path, TICKS).drop(tables.DATE)


# ---- panels and their parts ----


def _bare_ticks_1m(spark, sf_dir):
    """The rollup for panels that do not show anomalies: nothing needs scoring."""
    return rollup.rollup_ticks(views.ticks(spark, sf_dir).withColumn("is_anomaly", F.lit(False)))


def _bare_readings_1m(spark, sf_dir):
    return rollup.rollup_sensors(views.sensors(spark, sf_dir).withColumn("is_anomaly", F.lit(False)))


@register(
    "live_price",
    f"WITH {_TICKS} SELECT {_MINUTE} AS time, symbol AS metric, round(avg(price), 9) AS value FROM ticks GROUP BY ALL",
    averages=("value",),
)
def live_price(spark, sf_dir):
    return panels.live_price(_bare_ticks_1m(spark, sf_dir), None, None)


@register(
    "tick_throughput",
    f"WITH {_TICKS} SELECT {_MINUTE} AS time, symbol AS metric, count(*) AS value FROM ticks GROUP BY ALL",
)
def tick_throughput(spark, sf_dir):
    return panels.tick_throughput(_bare_ticks_1m(spark, sf_dir), None, None)


@register(
    "recent_price_anomalies",
    f"""WITH {_SCORED_TICKS} SELECT event_time AS time, symbol, price, round(zscore, 6) AS zscore FROM scored_ticks
WHERE is_anomaly ORDER BY event_time DESC, symbol, seq LIMIT 100""",
)
def recent_price_anomalies(spark, sf_dir):
    return panels.price_anomalies(_scored_ticks(spark, sf_dir), None, None)


# A range that leaves rows out on both sides, and what is stored: a refresh up to the 15th, one hour of the 9th
# appended later and refreshed by its log, everything after the 15th raw.
_RANGE = ("2024-01-06 12:00:30", "2024-01-22 09:30:00")
_IN_RANGE = f"bucket BETWEEN TIMESTAMP '{_RANGE[0]}' AND TIMESTAMP '{_RANGE[1]}'"
_STORED_AT = dt.datetime(2024, 1, 15, 10, 20, 30)
_LATE_HOURS = "event_time >= '2024-01-09 05:00:00' AND event_time < '2024-01-09 06:00:00'"


def _served(spark, rows, make, schema):
    """The buckets of the range out of a table stored in two refreshes, and the raw rows above them."""
    base = scratch_path(spark, "served")
    table = rollups.RollupTable(f"{base}/rollup", schema, make)
    rollups.create(spark, table)
    for run, (some, entry) in enumerate(((f"NOT ({_LATE_HOURS})", "first"), (_LATE_HOURS, "second"))):
        part = rows.where(some)
        tables.write_event_table(part, f"{base}/raw", ["event_time"], mode="append")
        rollups.log_touched(part, table, entry)
        raw = tables.read_event_table(spark, f"{base}/raw", rows.schema)
        rollups.refresh(raw, table, run, _STORED_AT)
    return rollups.served(raw, table, *_RANGE)


@register(
    "live_price_range",
    f"""WITH {_TICKS}, r AS (SELECT {_MINUTE} AS bucket, symbol, avg(price) AS value FROM ticks GROUP BY ALL)
SELECT bucket AS time, symbol AS metric, round(value, 9) AS value FROM r WHERE {_IN_RANGE}""",
    averages=("value",),
)
def live_price_range(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.lit(False))
    return panels.live_price(_served(spark, rows, rollup.rollup_ticks, TICKS_1M), *_RANGE)


@register(
    "tick_throughput_range",
    f"""WITH {_TICKS}, r AS (SELECT {_MINUTE} AS bucket, symbol, count(*) AS value FROM ticks GROUP BY ALL)
SELECT bucket AS time, symbol AS metric, value FROM r WHERE {_IN_RANGE}""",
)
def tick_throughput_range(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.lit(False))
    return panels.tick_throughput(_served(spark, rows, rollup.rollup_ticks, TICKS_1M), *_RANGE)


def _served_readings(spark, sf_dir):
    scored = _scored_sensors(spark, sf_dir).drop("anomaly_injected")
    return _served(spark, scored, rollup.rollup_sensors, SENSOR_READINGS_1M)


@register(
    "sensor_averages_range",
    f"""WITH {_SCORED_SENSORS}, r AS ({_sensors_rollup(_MINUTE)})
SELECT bucket AS time, machine_id || '/' || sensor_type AS metric, avg_value AS value FROM r WHERE {_IN_RANGE}""",
    averages=("value",),
)
def sensor_averages_range(spark, sf_dir):
    return panels.sensor_averages(_served_readings(spark, sf_dir), *_RANGE)


@register(
    "machine_anomalies_range",
    f"""WITH {_SCORED_SENSORS}, r AS ({_sensors_rollup(_MINUTE)})
SELECT bucket AS time, machine_id AS metric, anomaly_count AS value FROM r WHERE {_IN_RANGE}""",
)
def machine_anomalies_range(spark, sf_dir):
    return panels.machine_anomalies(_served_readings(spark, sf_dir), *_RANGE)


@register(
    "recent_price_anomalies_range",
    f"""WITH {_SCORED_TICKS} SELECT event_time AS time, symbol, price, round(zscore, 6) AS zscore FROM scored_ticks
WHERE is_anomaly AND event_time BETWEEN TIMESTAMP '{_RANGE[0]}' AND TIMESTAMP '{_RANGE[1]}'
ORDER BY event_time DESC, symbol, price LIMIT 100""",
)
def recent_price_anomalies_range(spark, sf_dir):
    """From the stored anomaly table: nothing is scored again."""
    path = scratch_path(spark, "anomalies")
    tables.write_anomaly_table(_scored_ticks(spark, sf_dir).drop("seq"), path)
    stored = tables.read_event_table(spark, path, TICKS)
    return panels.recent_anomalies(stored, ["symbol", "price", "zscore"], ["symbol", "price"], *_RANGE)


@register(
    "recent_sensor_anomalies_range",
    f"""WITH {_SCORED_SENSORS} SELECT event_time AS time, machine_id, sensor_id, sensor_type, value, round(zscore, 6) AS zscore
FROM scored_sensors WHERE is_anomaly AND event_time BETWEEN TIMESTAMP '{_RANGE[0]}' AND TIMESTAMP '{_RANGE[1]}'
ORDER BY event_time DESC, sensor_id, value LIMIT 100""",
)
def recent_sensor_anomalies_range(spark, sf_dir):
    path = scratch_path(spark, "anomalies")
    tables.write_anomaly_table(_scored_sensors(spark, sf_dir).drop("seq", "anomaly_injected"), path)
    stored = tables.read_event_table(spark, path, SENSOR_READINGS)
    columns = ["machine_id", "sensor_id", "sensor_type", "value", "zscore"]
    return panels.recent_anomalies(stored, columns, ["sensor_id", "value"], *_RANGE)


@register(
    "sensor_averages",
    f"""WITH {_SENSORS} SELECT {_MINUTE} AS time, machine_id || '/' || sensor_type AS metric, round(avg(value), 9) AS value
FROM sensors GROUP BY ALL""",
    averages=("value",),
)
def sensor_averages(spark, sf_dir):
    return panels.sensor_averages(_bare_readings_1m(spark, sf_dir), None, None)


_MACHINE_SQL = f"""WITH {_SCORED_SENSORS}, r AS ({_sensors_rollup(_MINUTE)})"""


@register("machine_anomalies", f"{_MACHINE_SQL} SELECT bucket AS time, machine_id AS metric, anomaly_count AS value FROM r")
def machine_anomalies(spark, sf_dir):
    return panels.machine_anomalies(rollup.rollup_sensors(_scored_sensors(spark, sf_dir)), None, None)


@register(
    "machine_anomalies_summed",
    f"{_MACHINE_SQL} SELECT bucket AS time, machine_id AS metric, CAST(sum(anomaly_count) AS BIGINT) AS value FROM r GROUP BY ALL",
)
def machine_anomalies_summed(spark, sf_dir):
    made = rollup.rollup_sensors(_scored_sensors(spark, sf_dir))
    return panels.machine_anomalies(made, None, None, summed=True)


@register(
    "recent_sensor_anomalies",
    f"""WITH {_SCORED_SENSORS} SELECT event_time AS time, machine_id, sensor_id, sensor_type, value, round(zscore, 6) AS zscore
FROM scored_sensors WHERE is_anomaly ORDER BY event_time DESC, sensor_id, seq LIMIT 100""",
)
def recent_sensor_anomalies(spark, sf_dir):
    return panels.sensor_anomalies(_scored_sensors(spark, sf_dir), None, None)


_STREAMS_SQL = f"""{_SCORED_TICKS}, {_SCORED_SENSORS}, streams AS (
  SELECT 'ticks' AS stream, event_time, is_anomaly FROM scored_ticks UNION ALL
  SELECT 'sensors', event_time, is_anomaly FROM scored_sensors)"""


def _streams(spark, sf_dir):
    return (
        _scored_ticks(spark, sf_dir)
        .select(F.lit("ticks").alias("stream"), "event_time", "is_anomaly")
        .unionByName(
            _scored_sensors(spark, sf_dir).select(F.lit("sensors").alias("stream"), "event_time", "is_anomaly")
        )
    )


@register(
    "events_per_second",
    f"""WITH {_STREAMS_SQL} SELECT {_MINUTE} AS window_start, stream, round(count(*) / 60.0, 6) AS per_second FROM streams GROUP BY ALL""",
)
def events_per_second(spark, sf_dir):
    plain = [
        table.select(F.lit(name).alias("stream"), "event_time")
        for name, table in (("ticks", views.ticks(spark, sf_dir)), ("sensors", views.sensors(spark, sf_dir)))
    ]
    return panels.events_per_second(plain[0].unionByName(plain[1]))


@register(
    "anomalies_per_second",
    f"""WITH {_STREAMS_SQL} SELECT {_MINUTE} AS window_start, stream,
  round(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) / 60.0, 6) AS per_second FROM streams GROUP BY ALL""",
)
def anomalies_per_second(spark, sf_dir):
    return panels.anomalies_per_second(_streams(spark, sf_dir))


@register(
    "event_rate_hopping",
    f"""WITH {_TICKS}, hops AS (SELECT symbol, time_bucket(INTERVAL '10 seconds', event_time) - h * INTERVAL '10 seconds' AS s
  FROM ticks, (SELECT unnest(generate_series(0, 5)) AS h))
SELECT s AS window_start, symbol, round(count(*) / 60.0, 6) AS per_second FROM hops GROUP BY ALL""",
)
def event_rate_hopping(spark, sf_dir):
    return health.event_rate(views.ticks(spark, sf_dir), ["symbol"], "1 minute", "10 seconds")


def _counter_sql(width: str) -> str:
    return f"""WITH samples AS (
  SELECT stream, event_id AS seq, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, CAST(event_id % cycle + 1 AS DOUBLE) AS value
  FROM events, (VALUES ('ticks', 3000), ('sensors', 7000)) AS c(stream, cycle)),
steps AS (SELECT *, time_bucket(INTERVAL '{width}', ts) AS window_start,
  lag(value) OVER (PARTITION BY stream, time_bucket(INTERVAL '{width}', ts) ORDER BY ts, seq) AS previous FROM samples),
spans AS (SELECT stream, window_start, sum(CASE WHEN value < previous THEN value ELSE value - previous END) AS increase,
  count(*) AS samples, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM steps GROUP BY ALL)
SELECT stream, window_start, increase, samples, round(increase / seconds, 6) AS per_second FROM spans WHERE samples > 1 AND seconds > 0"""


@register("counter_rate", _counter_sql("1 hour"))
def counter_rate(spark, sf_dir):
    samples = views.counter_samples(spark, sf_dir).drop("labels", "name")
    return health.counter_rate(samples, ["stream"], "1 hour", ["ts", "seq"])


@register("counter_rate_split_series", _counter_sql("5 days"))
def counter_rate_split_series(spark, sf_dir):
    """Wide windows, each split into blocks."""
    samples = views.counter_samples(spark, sf_dir).drop("labels", "name")
    return health.counter_rate(samples, ["stream"], "5 days", ["ts", "seq"], block_rows=300)


def _trailing_sql(width: int, step: int) -> str:
    """Each sample in every range that holds it, and the increase within the range alone."""
    return f"""WITH samples AS (
  SELECT stream, event_id AS seq, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, CAST(event_id % cycle + 1 AS DOUBLE) AS value
  FROM events, (VALUES ('ticks', 3000), ('sensors', 7000)) AS c(stream, cycle)),
ranged AS (SELECT *, CAST(ceil(epoch_us(ts) / {step}000000.0) AS BIGINT) + h AS n FROM samples, (SELECT unnest(generate_series(0, {width // step - 1})) AS h)),
steps AS (SELECT *, lag(value) OVER (PARTITION BY stream, n ORDER BY ts, seq) AS previous FROM ranged),
spans AS (SELECT stream, n, sum(CASE WHEN value < previous THEN value ELSE value - previous END) AS increase,
  count(*) AS samples, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM steps GROUP BY ALL)
SELECT stream, make_timestamp(n * {step}000000) AS at, increase, samples, round(increase / seconds, 6) AS per_second
FROM spans WHERE samples > 1 AND seconds > 0"""


@register("trailing_rate_1m", _trailing_sql(60, 15))
def trailing_rate_1m(spark, sf_dir):
    samples = views.counter_samples(spark, sf_dir).drop("labels", "name")
    return health.trailing_rate(samples, ["stream"], "1 minute", "15 seconds", ["ts", "seq"])


@register("trailing_rate_30s", _trailing_sql(30, 15))
def trailing_rate_30s(spark, sf_dir):
    """Each series split into blocks."""
    samples = views.counter_samples(spark, sf_dir).drop("labels", "name")
    return health.trailing_rate(samples, ["stream"], "30 seconds", "15 seconds", ["ts", "seq"], block_rows=700)


_BOUNDS_SQL = ", ".join(f"('{b}', {b})" for b in views.LATENCY_BOUNDS)
_BUCKETS_SQL = f"""bounds AS (SELECT * FROM (VALUES {_BOUNDS_SQL}, ('+Inf', 'inf'::DOUBLE)) AS b(le, bound)),
timed AS (SELECT event_type AS "table", value / 1000 AS seconds FROM events),
buckets AS (SELECT "table", le, bound, CAST(count(*) FILTER (seconds <= bound) AS DOUBLE) AS value FROM timed, bounds GROUP BY ALL)"""


@register("latency_buckets", f'WITH {_BUCKETS_SQL} SELECT "table", le, value FROM buckets')
def latency_buckets(spark, sf_dir):
    return views.latency_buckets(spark, sf_dir)


def _quantile_sql(q: float, by: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""WITH {_BUCKETS_SQL}, summed AS (SELECT {keys} bound, sum(value) AS c FROM buckets GROUP BY ALL),
ranked AS (SELECT *, lag(c, 1, 0) OVER w AS c0, lag(bound, 1, 0) OVER w AS b0, {q} * max(c) OVER ({part}) AS r FROM summed
  WINDOW w AS ({part} ORDER BY bound)),
hit AS (SELECT *, row_number() OVER ({part} ORDER BY bound) AS k FROM ranked WHERE c >= r)
SELECT {keys} round(CASE WHEN isinf(bound) THEN b0 ELSE b0 + (bound - b0) * (r - c0) / (c - c0) END, 6) AS quantile FROM hit WHERE k = 1"""


@register("write_latency_p99", _quantile_sql(0.99, '"table"'))
def write_latency_p99(spark, sf_dir):
    return panels.write_latency_p99(views.latency_buckets(spark, sf_dir))


_LATENCY_SAMPLES_SQL = f"""bounds AS (SELECT * FROM (VALUES {_BOUNDS_SQL}, ('+Inf', 'inf'::DOUBLE)) AS b(le, bound)),
timed AS (SELECT event_type AS "table", value / 1000 AS seconds, (epoch_us(ts) // 1000) AS ms FROM events),
minutes AS (SELECT "table", le, bound, ms // 60000 AS minute, max(ms) AS ms, count(*) FILTER (seconds <= bound) AS n FROM timed, bounds GROUP BY ALL),
samples AS (SELECT "table", le, bound, ms, sum(n) OVER (PARTITION BY "table", le, minute // 360 ORDER BY minute) AS value FROM minutes)"""


@register(
    "write_latency_p99_by_window",
    f"""WITH {_LATENCY_SAMPLES_SQL},
ranged AS (SELECT *, CAST(ceil(ms / 900000.0) AS BIGINT) + h AS n FROM samples, (SELECT unnest(generate_series(0, 7)) AS h)),
steps AS (SELECT *, lag(value) OVER (PARTITION BY "table", le, n ORDER BY ms) AS previous FROM ranged),
fallen AS (SELECT "table", bound, n, sum(CASE WHEN value < previous THEN value ELSE value - previous END) / ((max(ms) - min(ms)) / 1000.0) AS c
  FROM steps GROUP BY ALL HAVING count(*) > 1 AND max(ms) > min(ms)),
rates AS (SELECT "table", bound, n, max(c) OVER (PARTITION BY "table", n ORDER BY bound) AS c FROM fallen),
ranked AS (SELECT *, lag(c, 1, 0) OVER w AS c0, lag(bound, 1, 0) OVER w AS b0, max(c) OVER (PARTITION BY "table", n) AS total FROM rates
  WINDOW w AS (PARTITION BY "table", n ORDER BY bound)),
hit AS (SELECT *, row_number() OVER (PARTITION BY "table", n ORDER BY bound) AS k FROM ranked WHERE c >= 0.99 * total)
SELECT make_timestamp(n * 900000000) AS time, "table", round(CASE WHEN total > 0 THEN
  CASE WHEN isinf(bound) THEN b0 ELSE b0 + (bound - b0) * (0.99 * total - c0) / (c - c0) END END, 9) AS quantile FROM hit WHERE k = 1""",
    averages=("quantile",),
)
def write_latency_p99_by_window(spark, sf_dir):
    """The trailing two hours at every quarter of an hour, from counters that restart every six hours."""
    return panels.write_latency_p99_by_window(views.latency_samples(spark, sf_dir), "2 hours", "15 minutes")


@register("histogram_quantile", _quantile_sql(0.5, ""))
def histogram_quantile(spark, sf_dir):
    return health.histogram_quantile(views.latency_buckets(spark, sf_dir), 0.5)


_OFFSETS_SQL = """offsets AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'scorer' ELSE 'archiver' END AS grp, event_type AS topic,
  user_id % 5 AS "partition", max(event_id) + 1 AS log_end, coalesce(max(event_id) FILTER (value < 20) + 1, 0) AS committed FROM events GROUP BY ALL)"""


@register("consumer_lag", f"WITH {_OFFSETS_SQL} SELECT grp, CAST(sum(log_end - committed) AS BIGINT) AS lag FROM offsets GROUP BY grp")
def consumer_lag(spark, sf_dir):
    return panels.lag_by_group(views.offsets(spark, sf_dir))


@register(
    "consumer_lag_by_partition",
    f"""WITH {_OFFSETS_SQL} SELECT grp, topic, CAST("partition" AS INTEGER) AS "partition", CAST(sum(log_end - committed) AS BIGINT) AS lag
FROM offsets GROUP BY ALL""",
)
def consumer_lag_by_partition(spark, sf_dir):
    return health.consumer_lag(views.offsets(spark, sf_dir), ["grp", "topic", "partition"])


@register(
    "label_rollup",
    """SELECT stream, sum(CAST(event_id % cycle + 1 AS DOUBLE)) AS value
FROM events, (VALUES ('ticks', 3000), ('sensors', 7000)) AS c(stream, cycle) GROUP BY stream""",
)
def label_rollup(spark, sf_dir):
    return health.label_rollup(views.counter_samples(spark, sf_dir), ["stream"])


@register(
    "instant_value",
    """SELECT arg_max(CAST(event_id % 7000 + 1 AS DOUBLE), event_id) AS value FROM events
WHERE make_timestamp((epoch_us(ts) // 1000) * 1000) <= TIMESTAMP '2024-01-20 00:00:00'""",
)
def instant_value(spark, sf_dir):
    """``sensors`` comes before ``ticks``."""
    return health.instant_value(views.counter_samples(spark, sf_dir), "events_total", "2024-01-20 00:00:00")


_COUNTERS_SQL = f"""WITH {_SCORED_TICKS}, {_SCORED_SENSORS}, {_TICK_CHECKED}
SELECT 'ticks' AS stream, (SELECT count(*) FROM scored_ticks) AS events,
  (SELECT count(*) FROM scored_ticks WHERE is_anomaly) AS anomalies, (SELECT count(*) FROM checked WHERE reason IS NOT NULL) AS dead_letters
UNION ALL SELECT 'sensors', (SELECT count(*) FROM scored_sensors), (SELECT count(*) FROM scored_sensors WHERE is_anomaly), 0"""


@register("stream_counters", _COUNTERS_SQL)
def stream_counters(spark, sf_dir):
    scored = {"ticks": _scored_ticks(spark, sf_dir), "sensors": _scored_sensors(spark, sf_dir)}
    return health.stream_counters(scored, {"ticks": validate.parse_ticks(views.tick_lines(spark, sf_dir))[1]})


@register(
    "dead_lettered",
    f"""WITH {_TICK_CHECKED} SELECT 'ticks' AS stream, count(*) AS dead_letters FROM checked WHERE reason IS NOT NULL
UNION ALL SELECT 'sensors', (WITH {_SENSOR_CHECKED} SELECT count(*) FROM checked WHERE reason IS NOT NULL)""",
)
def dead_lettered(spark, sf_dir):
    return panels.dead_lettered(
        {
            "ticks": validate.parse_ticks(views.tick_lines(spark, sf_dir))[1],
            "sensors": validate.parse_sensors(views.sensor_lines(spark, sf_dir))[1],
        }
    )


_LOAD_SQL = f"""samples AS (SELECT CAST(CASE event_type {' '.join(f"WHEN '{k}' THEN {v}" for k, v in views.STAGES.items())} END AS INTEGER) AS hz,
  make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, value AS events_per_s, CAST(user_id AS DOUBLE) AS lag,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 AS p99_s FROM events),
stages AS (SELECT hz, avg(events_per_s) AS rate, max(p99_s) AS p99, arg_max(lag, ts) - arg_min(lag, ts) AS growth FROM samples GROUP BY hz),
summary AS (SELECT hz, round_even(rate, 1) AS avg_events_per_s, round_even(growth, 0) AS lag_growth, round_even(p99 * 1000, 1) AS max_p99_write_ms,
  CASE WHEN growth > rate THEN 'BREAKING (lag growing unbounded)' ELSE 'stable' END AS verdict FROM stages)"""


def _load_summary(spark, sf_dir):
    samples = views.load_samples(spark, sf_dir)
    return loadreport.load_stage_summary(samples, views.load_starts(samples))


@register("load_stage_summary", f"WITH {_LOAD_SQL} SELECT * FROM summary")
def load_stage_summary(spark, sf_dir):
    return _load_summary(spark, sf_dir)


@register(
    "load_ceiling",
    f"""WITH {_LOAD_SQL} SELECT min(hz) AS ceiling_hz, arg_min(avg_events_per_s, hz) AS avg_events_per_s
FROM summary WHERE verdict LIKE 'BREAKING%'""",
)
def load_ceiling(spark, sf_dir):
    return loadreport.find_ceiling(_load_summary(spark, sf_dir))


@register(
    "time_filtered",
    f"""WITH {_TICKS} SELECT seq, event_time, symbol, price, volume FROM ticks
WHERE event_time BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'""",
)
def time_filtered(spark, sf_dir):
    return times.time_filter(views.ticks(spark, sf_dir), "event_time", "2024-01-08 00:00:00", "2024-01-22 12:00:00")


@register(
    "time_filtered_from",
    f"WITH {_TICKS} SELECT seq, event_time FROM ticks WHERE event_time >= TIMESTAMP '2024-01-08 00:00:00'",
)
def time_filtered_from(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).select("seq", "event_time")
    return times.time_filter(rows, "event_time", "2024-01-08 00:00:00", None)


@register(
    "time_filtered_until",
    f"WITH {_TICKS} SELECT seq, event_time FROM ticks WHERE event_time <= TIMESTAMP '2024-01-22 12:00:00'",
)
def time_filtered_until(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).select("seq", "event_time")
    return times.time_filter(rows, "event_time", None, "2024-01-22 12:00:00")


@register(
    "anomalies_only",
    f"WITH {_SCORED_SENSORS} SELECT seq, sensor_id, value, round(zscore, 6) AS zscore FROM scored_sensors WHERE is_anomaly",
)
def anomalies_only(spark, sf_dir):
    return _scored_sensors(spark, sf_dir).where("is_anomaly").select("seq", "sensor_id", "value", "zscore")


@register("long_series", f"WITH {_TICKS} SELECT event_time AS time, symbol AS metric, price AS value FROM ticks")
def long_series(spark, sf_dir):
    return times.as_series(views.ticks(spark, sf_dir), "event_time", F.col("symbol"), "price")


@register(
    "machine_labels",
    f"WITH {_SENSORS} SELECT machine_id || '/' || sensor_type AS metric, count(*) AS readings FROM sensors GROUP BY ALL",
)
def machine_labels(spark, sf_dir):
    labelled = views.sensors(spark, sf_dir).select(times.machine_label().alias("metric"))
    return labelled.groupBy("metric").agg(F.count(F.lit(1)).alias("readings"))


@register(
    "flag_bits",
    f"""WITH {_SCORED_TICKS} SELECT seq, CASE WHEN flag THEN 1 ELSE 0 END AS bit
FROM (SELECT seq, CASE WHEN volume < 50 THEN is_anomaly END AS flag FROM scored_ticks)""",
)
def flag_bits(spark, sf_dir):
    """An unknown flag counts as 0."""
    flagged = _scored_ticks(spark, sf_dir).withColumn("flag", F.when(F.col("volume") < 50, F.col("is_anomaly")))
    return flagged.select("seq", times.flag_bit("flag").alias("bit"))


_WIDE_SQL = ", ".join(f"max(CASE WHEN symbol = '{s}' THEN v END) AS \"{s}\"" for s in views.STAGES)


@register(
    "wide_series",
    f"""WITH {_TICKS}, r AS (SELECT date_trunc('hour', event_time) AS time, symbol, round(avg(price), 9) AS v FROM ticks GROUP BY ALL)
SELECT time, {_WIDE_SQL} FROM r GROUP BY time""",
    averages=tuple(views.STAGES),
)
def wide_series(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.lit(False))
    hourly = rollup.rollup_ticks(ticks, "1 hour")
    series = times.as_series(hourly, "bucket", F.col("symbol"), "avg_price")
    return times.wide_series(series, list(views.STAGES))


@register(
    "ordered_series",
    f"""WITH {_TICKS} SELECT date_trunc('hour', event_time) AS time, symbol AS metric, round(avg(price), 9) AS value
FROM ticks GROUP BY ALL ORDER BY time""",
    averages=("value",),
)
def ordered_series(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.lit(False))
    return panels.live_price(rollup.rollup_ticks(ticks, "1 hour"), None, None)


# ---- streams ----


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = views.events(spark, sf_dir).drop("ms", "event_time").schema
    table = spark.readStream.schema(stored).parquet(f"{sf_dir}/events.parquet*")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table.withColumn("ms", ms).withColumn("event_time", times.to_event_ts(F.col("ms")))


def _in_pieces(spark: SparkSession, rows: DataFrame, piece: Column, pieces: int = 4) -> DataFrame:
    """``rows`` as a stream that gets one piece (0, 1, ...) per micro-batch, in this order."""
    path = scratch_path(spark, "pieces")
    numbered = rows.withColumn("_piece", piece)
    for i in range(pieces):
        numbered.where(F.col("_piece") == i).drop("_piece").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run_to_end(stream: DataFrame, spark, write, mode="append") -> None:
    queries.start(stream, write, scratch_path(spark, "query"), None, mode).awaitTermination()


@register("stream_score_ticks", _TICK_ROWS_SQL)
def stream_score_ticks(spark, sf_dir):
    """The running baseline carried from batch to batch in hash buckets of the keys."""
    path = scratch_path(spark, "stream-ticks")

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.append_scored(batch.select(*TICKS.fieldNames()), batch_id, path)

    run = batches.score_rows(write, scratch_path(spark, "stream-state"), ["symbol"], "price")
    _run_to_end(views.tick_columns(_event_stream(spark, sf_dir)), spark, run)
    return tables.read_event_table(spark, path, TICKS).select(*TICKS.fieldNames())


@register("stream_score_sliding", _SLIDING_TICKS_SQL)
def stream_score_sliding(spark, sf_dir):
    path = scratch_path(spark, "stream-sliding")
    rows = views.tick_columns(_event_stream(spark, sf_dir)).select("seq", "symbol", "price")
    run = batches.score_rows(late.append_to(path), scratch_path(spark, "stream-state"), ["symbol"], "price", sliding=True)
    _run_to_end(rows, spark, run)
    return spark.read.parquet(path).drop("batch_id")


_STREAM_LINES_SQL = f"""WITH {_TICK_CHECKED}, ticks AS (SELECT * FROM good_ticks), {_scored('ticks', 'symbol', 'price')}
SELECT make_timestamp(event_time * 1000) AS event_time, symbol, price, volume, round(zscore, 6) AS zscore, is_anomaly FROM scored_ticks"""


_STREAM_READINGS_SQL = f"""WITH {_SENSOR_CHECKED}, readings AS (SELECT seq, make_timestamp(({_int('event_time')}) * 1000) AS event_time,
  json_extract_string(j, '$.machine_id') AS machine_id, json_extract_string(j, '$.sensor_id') AS sensor_id,
  json_extract_string(j, '$.sensor_type') AS sensor_type, {_float('value')} AS value FROM checked WHERE reason IS NULL),
  {_scored('readings', 'sensor_id', 'value')}
SELECT event_time, machine_id, sensor_id, sensor_type, value, round(zscore, 6) AS zscore, is_anomaly FROM scored_readings"""


def _pipeline_folders(spark: SparkSession) -> batches.Folders:
    base = scratch_path(spark, "pipeline")
    return batches.Folders(*[f"{base}/{name}" for name in ("table", "dead-letters", "state", "metrics")])


@register("stream_tick_pipeline", _STREAM_LINES_SQL)
def stream_tick_pipeline(spark, sf_dir):
    """Raw lines to scored rows with split keys, faulty lines set aside on the way."""
    folders = _pipeline_folders(spark)
    line = views.lines_of(_event_stream(spark, sf_dir), views.TICK_LINE)
    _run_to_end(line, spark, batches.score_batches(batches.TICK_FEED, folders, ["seq"], block_rows=600))
    return tables.read_event_table(spark, folders.table, TICKS).select(*TICKS.fieldNames())


@register(
    "stream_rollup_ticks",
    f"""WITH {_TICKS}, scored_ticks AS (SELECT *, volume > 90 AS is_anomaly FROM ticks) {_ticks_rollup(_MINUTE)}""",
)
def stream_rollup_ticks(spark, sf_dir):
    """The rollup kept up by a stream, with flags that need no state."""
    rows = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.col("volume") > 90)
    path, schema = scratch_path(spark, "stream-rollup"), queries.summary_schema(rows, ["symbol"])
    # late beyond any watermark: the pieces come in no order of time
    stream = _in_pieces(spark, rows, F.col("seq") * 7919 % 4)
    _run_to_end(stream, spark, queries.fold_rollup(path, ["symbol"], "price"))
    queries.compact_rollup(spark, path, schema, ["symbol"], 1)
    return rollup.tick_buckets(queries.folded(spark, path, schema, ["symbol"]))


def _routed(spark, sf_dir):
    """Arrivals as a stream of four pieces that end within arrival batches: the folders of rows on time and late."""
    rows = views.arrivals(spark, sf_dir).select("seq", "ms", "batch", "arrival")
    ends = rows.agg(F.min("arrival").alias("lo"), (F.max("arrival") + 1).alias("hi")).first()
    piece = F.expr(f"(arrival - {ends.lo}) * 4 div {ends.hi - ends.lo}")
    base = scratch_path(spark, "routed")
    sinks = late.append_to(f"{base}/good"), late.append_to(f"{base}/late")
    run = late.route_late(f"{base}/marks", "ms", 600000, *sinks, arrival="batch")
    _run_to_end(_in_pieces(spark, rows, piece), spark, run)
    return f"{base}/good", f"{base}/late"


@register("stream_late_rows", _late_sql(600000, "seq, ms, batch, watermark_ms", "WHERE late"))
def stream_late_rows(spark, sf_dir):
    return spark.read.parquet(_routed(spark, sf_dir)[1]).select("seq", "ms", "batch", "watermark_ms")


@register("stream_on_time_rows", _late_sql(600000, "seq, ms, batch", "WHERE NOT late"))
def stream_on_time_rows(spark, sf_dir):
    return spark.read.parquet(_routed(spark, sf_dir)[0]).select("seq", "ms", "batch")


_STATS_SQL = f"""WITH {_TICK_CHECKED}, ticks AS (SELECT * FROM good_ticks), {_scored('ticks', 'symbol', 'price')},
counts AS (SELECT (SELECT count(*) FROM scored_ticks) AS events, (SELECT count(*) FROM scored_ticks WHERE is_anomaly) AS anomalies,
  (SELECT count(*) FROM checked WHERE reason IS NOT NULL) AS dead_letters)
SELECT 'events' AS name, '{{"stream":"ticks"}}' AS labels, CAST(events AS DOUBLE) AS value FROM counts
UNION ALL SELECT 'anomalies', '{{"stream":"ticks"}}', anomalies FROM counts
UNION ALL SELECT 'dead_letters', '{{"stream":"ticks"}}', dead_letters FROM counts
UNION ALL SELECT 'last_batch_rows', '{{"table":"ticks"}}', events FROM counts
UNION ALL SELECT 'write_seconds', '{{"table":"ticks"}}', 1 FROM counts"""


@register("stream_write_stats", _STATS_SQL)
def stream_write_stats(spark, sf_dir):
    """Rows per stream and table as recorded by the pipeline; of the write times, which differ, the number measured."""
    folders = _pipeline_folders(spark)
    line = views.lines_of(_event_stream(spark, sf_dir), views.TICK_LINE)
    _run_to_end(line, spark, batches.score_batches(batches.TICK_FEED, folders, ["seq"]))
    samples = spark.read.parquet(folders.metrics)
    timed = F.col("name") == "write_seconds"
    return samples.select("name", F.to_json("labels").alias("labels"), F.when(timed, 1.0).otherwise(F.col("value")).alias("value"))


@register("stream_sensor_pipeline", _STREAM_READINGS_SQL)
def stream_sensor_pipeline(spark, sf_dir):
    """The sensor feed: raw lines to scored readings."""
    folders = _pipeline_folders(spark)
    names = dict(zip(["machine_id", "sensor_id", "sensor_type"], views.sensor_names()))
    line = views.lines_of(_event_stream(spark, sf_dir).withColumns(names), views.SENSOR_LINE)
    _run_to_end(line, spark, batches.score_batches(batches.SENSOR_FEED, folders, ["seq"], block_rows=600))
    return tables.read_event_table(spark, folders.table, SENSOR_READINGS).select(*SENSOR_READINGS.fieldNames())


@register("stream_keyed_feed", f"WITH {_TICKS} SELECT symbol AS key, seq AS record_offset, price FROM ticks")
def stream_keyed_feed(spark, sf_dir):
    """A topic read as a stream, one file at a time, and drained."""
    path, out = scratch_path(spark, "topic"), scratch_path(spark, "read")
    rows = views.ticks(spark, sf_dir)
    feeds.write_keyed(rows, "symbol", path, "seq", F.col("event_time"), ["symbol", "price"])
    stream = feeds.read_events_stream(spark, path, "parquet", per_trigger=1)
    query = queries.start(stream, late.append_to(out), scratch_path(spark, "query"))
    queries.drain(query)
    price = F.from_json("raw", "price double")["price"].alias("price")
    return spark.read.parquet(out).select("key", F.col("offset").alias("record_offset"), price)


@register("stream_trade_frames", f"WITH {_lines_sql(views.FRAME_LINE)} SELECT raw, count(*) AS n FROM lines GROUP BY raw")
def stream_trade_frames(spark, sf_dir):
    """Frames as lines of text files, read as a stream."""
    path, out = scratch_path(spark, "frames"), scratch_path(spark, "read")
    views.frame_lines(spark, sf_dir).select("raw").write.text(path)
    _run_to_end(feeds.read_trade_frames(spark, path, streaming=True), spark, late.append_to(out))
    return spark.read.parquet(out).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


@register(
    "progress_counters",
    f"""WITH {_TICKS} SELECT 'events_total' AS name, '' AS le, CAST(count(*) AS DOUBLE) AS value FROM ticks
UNION ALL SELECT 'anomalies_total', '', count(*) FROM ticks WHERE volume > 90 UNION ALL SELECT 'write_seconds_bucket', '+Inf', 4""",
)
def progress_counters(spark, sf_dir):
    """What the progress of a drained query counts up to: events, anomalies and one write time per batch."""
    rows = views.ticks(spark, sf_dir).withColumn("is_anomaly", F.col("volume") > 90)
    stream = queries.with_counters(_in_pieces(spark, rows, F.col("seq") % 4), "ticks")
    query = queries.start(stream, late.append_to(scratch_path(spark, "read")), scratch_path(spark, "query"), None)
    query.awaitTermination()
    counters = progress.ProgressCounters("ticks", "ticks")
    counters.record_all(query.recentProgress)
    le = F.coalesce(F.col("labels")["le"], F.lit(""))
    samples = counters.flush(spark).where((le == "") | (le == "+Inf"))
    return samples.groupBy("name", le.alias("le")).agg(F.max("value").alias("value"))
