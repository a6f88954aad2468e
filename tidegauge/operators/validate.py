"""Turn raw text into records, and set aside what cannot be used together with a reason.

Each parser has a ``check_*`` form that gives one DataFrame with a ``reason`` column (NULL for good
rows), and a form that splits it into ``(good, bad)``. Columns other than the text are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as p


def _split(checked: DataFrame, good: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return (
        checked.where(F.col("reason").isNull()).select(*good),
        checked.where(F.col("reason").isNotNull()).drop(*[c for c in good if c in _RECORD]),
    )


_RECORD = {
    "symbol", "price", "volume", "event_time", "machine_id", "sensor_id", "sensor_type", "value",
    "anomaly_injected",
}


def _document_reason(doc: Column) -> Column:
    return F.when(doc.isNull(), F.lit("bad_json")).when(~p.is_object(doc), F.lit("not_object"))


def _required(f: p.Field, fault: Column) -> Column:
    return F.coalesce(f.presence(), fault)


# ---- vendor frames ----


def check_frames(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse frames: adds the VARIANT ``frame`` and ``reason``."""
    parsed = p.parse_json(df, raw, "frame")
    return p.compute_once(parsed, reason=_document_reason(F.col("frame")))


def parse_frames(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    checked = check_frames(df, raw)
    return (
        checked.where(F.col("reason").isNull()).drop("reason"),
        checked.where(F.col("reason").isNotNull()).drop("frame"),
    )


def only_trades(frames: DataFrame) -> DataFrame:
    """Frames of type ``trade``; the others are control messages, neither good nor bad."""
    kind = p.field(F.col("frame"), "type")
    return frames.where((F.try_variant_get(kind, "$", "string") == "trade") & (p.kind_of(kind) == "STRING"))


def explode_trades(frames: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """One row per entry of ``data`` with its position; frames whose data is no list are bad."""
    data = p.field(F.col("frame"), "data")
    listed = frames.withColumn("_data", F.try_variant_get("frame", "$.data", "array<variant>"))
    bad = data.isNotNull() & F.col("_data").isNull()
    rows = listed.where(~bad).select(
        *[c for c in frames.columns if c not in ("frame", raw)],
        F.posexplode("_data").alias("trade_index", "trade"),
    )
    rejected = listed.where(bad).withColumn("reason", F.lit("bad_data")).drop("frame", "_data")
    return rows, rejected


def check_trades(trades: DataFrame) -> DataFrame:
    """Rename and convert the fields of each trade; adds ``reason``, and ``raw`` for the bad ones."""
    kept = [c for c in trades.columns if c != "trade"]
    t = F.col("trade")
    marked = p.compute_once(trades, _is_object=p.is_object(t))
    fields = p.with_fields(marked, F.when(F.col("_is_object"), t), ("s", "p", "v", "t"))
    s, price, volume, time = (
        p.Field(k, n) for k, n in (("s", "symbol"), ("p", "price"), ("v", "volume"), ("t", "event_time"))
    )
    made = p.compute_once(
        fields,
        symbol=s.text(),
        price=price.float(),
        # a volume that is left out is zero, one that is null is an error
        volume=F.when(volume.is_missing, F.lit(0.0)).otherwise(volume.float()),
        event_time=time.int(),
    )
    reason = F.coalesce(
        F.when(~F.col("_is_object"), F.lit("not_object")),
        _required(s, s.text_fault(F.col("symbol"))),
        _required(price, price.float_fault(F.col("price"))),
        F.when(volume.is_null, F.lit("null_volume")),
        volume.float_fault(F.col("volume")),
        _required(time, time.fault(F.col("event_time"))),
    )
    made = p.compute_once(made, reason=reason, raw=F.when(reason.isNotNull(), F.to_json(t)))
    return made.select(*kept, "raw", "symbol", "price", "volume", "event_time", "reason")


def normalise_trades(trades: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = check_trades(trades)
    kept = [c for c in trades.columns if c != "trade"]
    return _split(checked, [*kept, "symbol", "price", "volume", "event_time"])


def trades_of_frames(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """The whole way from frame text to tick records; bad frames and bad trades are stacked."""
    frames, bad_frames = parse_frames(df, raw)
    trades, bad_data = explode_trades(only_trades(frames), raw)
    good, bad_trades = normalise_trades(trades)
    bad = bad_frames.unionByName(bad_data).unionByName(bad_trades, allowMissingColumns=True)
    return good, bad


# ---- tick and sensor records ----


def _documents(df: DataFrame, raw: str, names: Sequence[str]) -> DataFrame:
    return p.with_fields(p.parse_json(df, raw, "_doc"), F.col("_doc"), names)


def check_ticks(df: DataFrame, raw: str = "raw") -> DataFrame:
    names = ("symbol", "price", "volume", "event_time")
    symbol, price, volume, time = (p.Field(c, c) for c in names)
    made = p.compute_once(
        _documents(df, raw, names),
        symbol=symbol.text(),
        price=price.float(),
        # a volume that is left out is zero, one that is null stays null
        volume=F.when(volume.is_missing, F.lit(0.0)).otherwise(volume.float()),
        event_time=time.int(),
    )
    reason = F.coalesce(
        _document_reason(F.col("_doc")),
        _required(symbol, symbol.text_fault(F.col("symbol"))),
        _required(price, price.float_fault(F.col("price"))),
        _required(time, time.fault(F.col("event_time"))),
        F.when(~volume.is_null, volume.float_fault(F.col("volume"))),
    )
    return p.compute_once(made, reason=reason).select(*df.columns, *names, "reason")


def parse_ticks(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    kept = [c for c in df.columns if c != raw]
    return _split(check_ticks(df, raw), [*kept, "symbol", "price", "volume", "event_time"])


def check_sensors(df: DataFrame, raw: str = "raw") -> DataFrame:
    texts = ("machine_id", "sensor_id", "sensor_type")
    names = (*texts, "value", "event_time", "anomaly_injected")
    value, time = p.Field("value", "value"), p.Field("event_time", "event_time")
    made = p.compute_once(
        _documents(df, raw, names),
        **{c: p.Field(c, c).text() for c in texts},
        value=value.float(),
        event_time=time.int(),
        anomaly_injected=F.try_variant_get(F.col("_anomaly_injected"), "$", "boolean"),
    )
    reason = F.coalesce(
        _document_reason(F.col("_doc")),
        *[_required(f, f.text_fault(F.col(f.name))) for f in (p.Field(c, c) for c in texts)],
        _required(value, value.float_fault(F.col("value"))),
        _required(time, time.fault(F.col("event_time"))),
    )
    return p.compute_once(made, reason=reason).select(*df.columns, *names, "reason")


def parse_sensors(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    kept = [c for c in df.columns if c != raw]
    record = ["machine_id", "sensor_id", "sensor_type", "value", "event_time", "anomaly_injected"]
    return _split(check_sensors(df, raw), [*kept, *record])


def enforce_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all the columns set, and the others with ``null_<column>`` of the first unset one."""
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in columns])
    checked = df.withColumn("reason", reason)
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where("reason IS NOT NULL")
