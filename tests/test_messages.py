import json

import pytest
from pyspark.sql import functions as F

from fieldgauge.operators import alerts, messages
from fieldgauge.schema import ALERT_INVALID_TEXT


def message(**changes):
    weather = {"humidity": 80, "temperature": 76, "wind_speed": 12} | changes.pop("weather", {})
    out = {
        "station_id": 5,
        "s_no": 9,
        "battery_status": "low",
        "status_timestamp": 1714521600,
        "weather": weather,
    } | changes
    return json.dumps(out)


GOOD = message()
CASES = {
    # name: (text, reason, humidity, alert)
    "good": (GOOD, None, 80, "rain"),
    "null": (None, "not an envelope", None, None),
    "empty": ("", "not an envelope", None, None),
    "blank": (" \t\n", "not an envelope", None, None),
    "plain": ("hello", "not an envelope", None, None),
    "array": ("[1]", "not an envelope", None, None),
    "array_of_messages": (f"[{GOOD}]", "not an envelope", None, None),
    "leading_blanks": ("\t\n " + GOOD, None, 80, "rain"),
    "truncated": ('{"station_id":3,', "unparsable", None, None),
    "truncated_late": (GOOD[:-1], "unparsable", None, None),
    "single_quotes": (GOOD.replace('"', "'"), "unparsable", None, None),
    "not_a_number": (GOOD.replace("80", "NaN"), "unparsable", None, None),
    "only_station": (
        '{"station_id":3}',
        "missing or invalid: s_no, battery_status, status_timestamp, "
        "weather.humidity, weather.temperature, weather.wind_speed",
        None,
        None,
    ),
    "no_temperature": (
        GOOD.replace('"temperature"', '"t"'),
        "missing or invalid: weather.temperature",
        80,
        "invalid",
    ),
    "number_as_text": (message(weather={"humidity": "80"}), None, 80, "rain"),
    "fraction": (message(weather={"humidity": 70.9}), None, 70, None),
    "edge_70": (message(weather={"humidity": 70}), None, 70, None),
    "edge_71": (message(weather={"humidity": 71}), None, 71, "rain"),
    "boolean": (
        message(weather={"humidity": True}),
        "missing or invalid: weather.humidity",
        None,
        None,
    ),
    "word": (message(weather={"humidity": "x"}), "missing or invalid: weather.humidity", None, None),
    "nan_text": (
        message(weather={"humidity": "NaN"}),
        "missing or invalid: weather.humidity",
        None,
        None,
    ),
    "too_large": (
        message(weather={"humidity": 1e300}),
        "missing or invalid: weather.humidity",
        None,
        None,
    ),
    "trailing_text": (GOOD + " xx", None, 80, "rain"),
    "repeated_field": (
        GOOD.replace('"humidity": 80', '"humidity": 10, "humidity": 90'),
        None,
        90,
        "rain",
    ),
    "far_future": (
        message(status_timestamp=9_000_000_000_000_000_000),
        "missing or invalid: status_timestamp",
        80,
        "rain",
    ),
    "long_station": (message(station_id=9007199254740993), None, 80, "rain"),
    "more_fields": (message(extra=[1, {"a": "}"}]), None, 80, "rain"),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(name, case[0]) for name, case in CASES.items()]
    return spark.createDataFrame(data, "key string, value string")


def test_reason_and_fields(rows):
    got = {r.key: (r.reason, r.humidity) for r in messages.classify(rows).collect()}
    assert got == {name: (case[1], case[2]) for name, case in CASES.items()}


def test_each_row_is_good_or_dead(rows):
    classified = messages.classify(rows)
    good, dead = messages.readings(classified), messages.dead_letters(classified, "key", "value")
    assert good.count() + dead.count() == len(CASES)
    assert {r.key for r in dead.collect()} == {n for n, c in CASES.items() if c[1]}


def test_alerts(rows):
    got = {r.key: r.value for r in alerts.rain_alerts(rows).collect()}
    assert set(got) == {name for name, case in CASES.items() if case[3]}
    assert got["no_temperature"] == ALERT_INVALID_TEXT == '{\n    "alert": "INVALID DATA"\n}\n'
    assert got["good"] == (
        '{\n    "alert": "RAIN DETECTED",\n    "humidity": 80,\n    "temperature": 76\n}\n'
    )


def test_long_ids_keep_all_digits(rows):
    row = messages.classify(rows).filter("key = 'long_station'").first()
    assert row.station_id == 9007199254740993


def test_text_is_parsed_once(rows):
    for df in (messages.readings(messages.classify(rows)), alerts.rain_alerts(rows)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_default_key(spark):
    rows = spark.createDataFrame([(None, "a"), ("7", "b")], "key string, value string")
    got = {r.value: r.key for r in messages.with_default_key(rows).collect()}
    assert got == {"a": "unknown_station", "b": "7"}


def test_normalise(rows):
    compact = {r.key: r.value for r in messages.normalise_json(rows).collect()}
    spaced = {r.key: r.value for r in messages.normalise_json(rows, spaced=True).collect()}
    assert compact["leading_blanks"] == json.dumps(json.loads(GOOD), separators=(",", ":"))
    assert spaced["leading_blanks"] == GOOD
    assert compact["plain"] == spaced["plain"] == "hello"
    other = rows.filter("key = 'good'").withColumn("station_id", F.lit("mine"))
    assert messages.normalise_json(other).first().station_id == "mine"
    quoted = rows.filter("key = 'good'").withColumn(
        "value", F.replace("value", F.lit('"low"'), F.lit(r'"a\"b\n]"'))
    )
    text = messages.normalise_json(quoted, spaced=True).first().value
    assert json.loads(text)["battery_status"] == 'a"b\n]'


@pytest.mark.parametrize(
    "text",
    [
        '{"b": 1, "a": {"x": [1, 2.5, {"y": null}], "z": "p: q, \\"r\\" \\\\"}, "b": true}',
        '\n{ "weather" : {"gust": 7.5,\n"humidity":"80"}, "firmware":"1"}',
        "{}",
    ],
)
def test_normalise_keeps_every_field(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    pairs = json.loads(text, object_pairs_hook=lambda p: p)
    for spaced in (False, True):
        got = messages.normalise_json(df, spaced=spaced).first().value
        assert json.loads(got, object_pairs_hook=lambda p: p) == pairs
        if text.count('"b"') < 2:
            separators = (", ", ": ") if spaced else (",", ":")
            assert got == json.dumps(json.loads(text), separators=separators)


def test_normalise_leaves_other_text(spark):
    texts = ["hello", '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', '{"a":1}}', '{"a"', "[1]", None, "{'a':1}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r.value for r in messages.normalise_json(df).collect()] == texts


def test_messages_keyed_by_station(rows):
    good = messages.readings(messages.classify(rows.filter("key = 'good'")))
    row = messages.to_messages(good).first()
    assert row.key == "5"
    assert json.loads(row.value) == json.loads(GOOD)


def test_adapt_feed(spark):
    docs = [
        ("a", 1, '{"current":{"time":"2026-05-22T12:30","interval":900,"temperature_2m":23.6,'
                 '"relative_humidity_2m":65,"wind_speed_10m":16.2}}'),
        ("a", 2, '{"current":{"temperature_2m":-0.9,"relative_humidity_2m":"40"}}'),
        ("b", 3, "{}"),
        ("a", 4, '{"current":{"temperature_2m":1e12}}'),
        ("a", 5, "hello"),
        ("a", 6, None),
        ("a", 7, '{"current":{"temperature_2m":1'),
        ("b", 8, '{"error":true}'),
    ]
    df = spark.createDataFrame(docs, "feed string, n bigint, doc string")
    got = messages.adapt_ordered_feed(
        df, "doc", F.lit(11).cast("bigint"), F.lit(100).cast("bigint"), ["feed"], ["n"]
    )
    rows = {
        r.n: (r.s_no, r.battery_status, r.humidity, r.temperature, r.wind_speed)
        for r in got.collect()
    }
    assert rows == {
        1: (1, "high", 65, 23, 16),
        2: (2, "high", 40, 0, 0),
        3: (1, "high", 0, 0, 0),
        4: (3, "high", 0, 2147483647, 0),
        8: (2, "high", 0, 0, 0),
    }
    all_rows = messages.adapt_feed(df, "doc", F.lit(11), F.lit(100), F.col("n"))
    reasons = {r.s_no: (r.reason, r.humidity) for r in all_rows.filter("reason is not null").collect()}
    assert reasons == {5: ("unparsable", None), 6: ("no document", None), 7: ("unparsable", None)}
