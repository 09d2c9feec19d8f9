"""Random documents against the coercion rules, stated again in plain Python."""

import json
import random
import re

from fieldgauge.operators import alerts, messages
from fieldgauge.schema import READING

LIMITS = {"bigint": 2**63, "int": 2**31}
VALUES = [
    0, 1, 70, 71, 90, -5, 2**31 - 1, 2**31, 2**53 + 1, 2**63 - 1, 70.9, 71.5, -0.9, 1e3, 1e20, 2.5e-3,
    "80", " 71 ", "70.99", "-3", "x", "", "1e2", "NaN", "Infinity", "true", "+72",
    True, False, None, {"a": 1}, [90], [], "é\"\\\n",
]
MISSING = object()


def number(value, kind):
    if isinstance(value, bool) or value is None or isinstance(value, (dict, list)):
        return None
    if isinstance(value, str):
        text = value.strip()
        if re.fullmatch(r"[+-]?\d+", text):
            value = int(text)
        elif re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text):
            value = float(text)
        else:
            return None
    value = int(value)
    return value if -LIMITS[kind] <= value < LIMITS[kind] else None


def expected(document):
    weather = document.get("weather")
    flat = document | (weather if isinstance(weather, dict) else {})
    out = {}
    for f in READING.fields:
        value = flat.get(f.name)
        kind = f.dataType.simpleString()
        out[f.name] = number(value, kind) if kind != "string" else value
    return out


def documents(seed, n):
    rng = random.Random(seed)

    def pick(good):
        roll = rng.random()
        return good if roll < 0.8 else MISSING if roll < 0.85 else rng.choice(VALUES)

    def clean(fields):
        items = [(k, v) for k, v in fields.items() if v is not MISSING]
        rng.shuffle(items)
        return dict(items)

    for _ in range(n):
        weather = clean(
            {"humidity": pick(rng.randrange(101)), "temperature": pick(76), "wind_speed": pick(3)}
        )
        # Status stays text or is absent: how other values print is not part of the rules.
        yield clean(
            {
                "station_id": pick(5),
                "s_no": pick(rng.randrange(10**12)),
                "battery_status": rng.choice(["low", "high", "é\"\\\n", MISSING, None]),
                "status_timestamp": pick(1714521600),
                "weather": weather if rng.random() < 0.95 else rng.choice([None, MISSING, {}]),
            }
        )


def test_random_documents(spark):
    docs = list(documents(7, 3000))
    rows = [
        (i, json.dumps(d, ensure_ascii=i % 2 == 0, separators=((",", ":") if i % 3 else (" , ", " : "))))
        for i, d in enumerate(docs)
    ]
    df = spark.createDataFrame(rows, "id bigint, value string")
    got = {r.id: r for r in messages.classify(df).collect()}
    hits = {r.id for r in alerts.rain_alerts(df).collect()}
    assert len(got) == len(docs)
    for i, document in enumerate(docs):
        want = expected(document)
        assert {n: got[i][n] for n in READING.names} == want, rows[i]
        at = want["status_timestamp"]
        usable = all(v is not None for v in want.values()) and -62135596800 <= at <= 253402300799
        assert (got[i].reason is None) == usable, rows[i]
        assert (i in hits) == (want["humidity"] is not None and want["humidity"] > 70), rows[i]


def test_cut_documents_are_never_good(spark):
    rng = random.Random(3)
    texts = [json.dumps(d) for d in documents(11, 1500)]
    rows = [(i, t[: rng.randrange(1, len(t))]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id bigint, value string")
    reasons = {r.reason for r in messages.classify(df).select("reason").collect()}
    assert reasons == {"unparsable"}
    assert alerts.rain_alerts(df).count() == 0
