import pytest

from tidegauge.operators import validate

TICK_LINES = [
    ('{"symbol":"A","price":"1.5","event_time":"17"}', ("A", 1.5, 0.0, 17)),
    ('{"symbol":"A","price":1,"event_time":1.9,"volume":null}', ("A", 1.0, None, 1)),
    ('{"symbol":"A","price":true,"event_time":1}', ("A", 1.0, 0.0, 1)),
    ('{"symbol":"A","price":"x","event_time":1}', "bad_price"),
    ('{"symbol":"A","price":1,"event_time":"1.9"}', "bad_event_time"),
    ('{"symbol":"A","price":1}', "missing_event_time"),
    ('{"symbol":null,"price":1,"event_time":1}', "null_symbol"),
    ('{"symbol":{"a":1},"price":1,"event_time":1}', "bad_symbol"),
    ('{"symbol":7,"price":1,"event_time":1}', "bad_symbol"),
    ('{"symbol":"A","price":1e400,"event_time":1}', "non_finite"),
    ('{"symbol":"A","price":1,"event_time":1e400}', "non_finite"),
    ('{"symbol":"A","price":"-Infinity","event_time":1}', "non_finite"),
    ('{"symbol":"A","price":1,"event_time":1} x', "bad_json"),
    ('{"symbol":"A","price":1,"event_time":1}}', "bad_json"),
    ('{"symbol":"A","price":1,"event_time":1},"end":3} z', "bad_json"),
    ("not json", "bad_json"),
    ("", "bad_json"),
    ("[1]", "not_object"),
    ("null", "not_object"),
    ('"s"', "not_object"),
    ('{"symbol":"A","price":null,"event_time":1}', "null_price"),
    ('{"price":1,"event_time":1}', "missing_symbol"),
    ('{"symbol":"A","price":"1.5d","event_time":1}', "bad_price"),
    ('{"symbol":"A","price":"0x1p3","event_time":1}', "bad_price"),
    ('{"symbol":"A","price":" 1_0.5 ","event_time":" 1_7 "}', ("A", 10.5, 0.0, 17)),
    ('{"symbol":"A","price":1,"event_time":1,"volume":"q"}', "bad_volume"),
    ('{"symbol":"A","price":1,"event_time":1,"volume":"2"}', ("A", 1.0, 2.0, 1)),
    ('{"symbol":"A","symbol":"B","price":1,"event_time":1}', ("B", 1.0, 0.0, 1)),
    ('{"symbol":"A","price":1,"event_time":99999999999999999999}', "bad_event_time"),
    ('{"symbol":"é\\u0041","price":-1.25e2,"event_time":1704067211172,"volume":3}', ("éA", -125.0, 3.0, 1704067211172)),
]


def test_tick_lines(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(TICK_LINES)], "i int, raw string")
    good, bad = validate.parse_ticks(df)
    found = {r.i: (r.symbol, r.price, r.volume, r.event_time) for r in good.collect()}
    reasons = {r.i: (r.raw, r.reason) for r in bad.collect()}
    assert len(found) + len(reasons) == len(TICK_LINES)
    for i, (line, want) in enumerate(TICK_LINES):
        if isinstance(want, str):
            assert reasons[i] == (line, want)
        else:
            assert found[i] == want, line


@pytest.mark.parametrize(
    "line,want",
    [
        ('{"machine_id":"m","sensor_id":"s","sensor_type":"t","value":"2.5","event_time":3,"anomaly_injected":true}', ("m", "s", "t", 2.5, 3, True)),
        ('{"machine_id":"m","sensor_id":"s","sensor_type":"t","value":2,"event_time":3}', ("m", "s", "t", 2.0, 3, None)),
        ('{"sensor_id":"s","sensor_type":"t","value":2,"event_time":3}', "missing_machine_id"),
        ('{"machine_id":"m","sensor_id":3,"sensor_type":"t","value":2,"event_time":3}', "bad_sensor_id"),
        ('{"machine_id":"m","sensor_id":"s","sensor_type":null,"value":2,"event_time":3}', "null_sensor_type"),
        ('{"machine_id":"m","sensor_id":"s","sensor_type":"t","value":"nan","event_time":3}', "non_finite"),
        ('{"machine_id":"m","sensor_id":"s","sensor_type":"t","value":[1],"event_time":3}', "bad_value"),
        ('{"machine_id":"m","sensor_id":"s","sensor_type":"t","value":1,"event_time":null}', "null_event_time"),
    ],
)
def test_sensor_lines(spark, line, want):
    good, bad = validate.parse_sensors(spark.createDataFrame([(line,)], "raw string"))
    if isinstance(want, str):
        assert [r.reason for r in bad.collect()] == [want] and good.count() == 0
    else:
        assert [tuple(r) for r in good.collect()] == [want] and bad.count() == 0


def test_frames(spark):
    lines = [
        '{"type":"ping"}',
        '{"type":"trade"}',
        '{"type":"trade","data":null}',
        '{"type":"trade","data":{"a":1}}',
        '{"type":"trade","data":[{"s":"A","p":1.5,"t":1,"v":2},{"s":"B","p":"x","t":2},"junk",{"s":"C","p":1,"t":3,"v":null}]}',
        "zzz",
        "[3]",
        '{"type":7}',
        '{"type":"trade","data":[]}',
        '{"type":"trade","data":[{"s":null,"p":1,"t":1},{"p":1,"t":1},{"s":"D","p":"2","t":"5"}]}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, raw string")
    good, bad = validate.trades_of_frames(df)
    assert sorted((r.i, r.trade_index, r.symbol, r.price, r.volume, r.event_time) for r in good.collect()) == [
        (4, 0, "A", 1.5, 2.0, 1),
        (9, 2, "D", 2.0, 0.0, 5),
    ]
    reasons = sorted(((r.i, r.trade_index, r.reason, r.raw) for r in bad.collect()), key=repr)
    assert [(i, t, reason) for i, t, reason, _ in reasons] == [
        (2, None, "bad_data"),
        (3, None, "bad_data"),
        (4, 1, "bad_price"),
        (4, 2, "not_object"),
        (4, 3, "null_volume"),
        (5, None, "bad_json"),
        (6, None, "not_object"),
        (9, 0, "null_symbol"),
        (9, 1, "missing_symbol"),
    ]
    assert reasons[0][3] == lines[2] and reasons[3][3] == '"junk"'


def test_not_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)], "x string, y int")
    good, bad = validate.enforce_not_null(df, ["y", "x"])
    assert [tuple(r) for r in good.collect()] == [("a", 1)]
    assert sorted(r.reason for r in bad.collect()) == ["null_x", "null_y", "null_y"]


def test_parsing_runs_once_per_row(spark):
    df = spark.createDataFrame([("{}",)], "raw string")
    plan = validate.parse_ticks(df)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") + plan.count("tryParseJson") <= 2
