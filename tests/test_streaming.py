import datetime
import json

import pytest
from pyspark.sql import functions as F

from fieldgauge.operators.latest import latest_per_key
from fieldgauge.operators.messages import adapt_feed
from fieldgauge.schema import LOG, MESSAGE
from fieldgauge.sources.archive import read_archive
from fieldgauge.sources.change_log import ChangeLog
from fieldgauge.sources.feeds import stream_documents
from fieldgauge.sources.topics import stream_files
from fieldgauge.streaming.ingest import DRAIN, message_log, split_batch, start_alerts, start_ingest, start_latest


def message(station, number, humidity=50, at=1714521600):
    weather = {"humidity": humidity, "temperature": 70, "wind_speed": 5}
    return json.dumps(
        {"station_id": station, "s_no": number, "battery_status": "low", "status_timestamp": at, "weather": weather}
    )


BATCHES = [
    [("1", message(1, 1), 0, 0), (None, message(5, 1, 90), 0, 1), ("2", "hello", 0, 2)],
    # Later arrival with an earlier event time still replaces.
    [("1", message(1, 2, 71, at=5), 0, 3), ("2", '{"station_id":2,', 0, 4), ("3", None, 0, 5)],
    [("1", message(1, 3, 70), 0, 6), ("3", message(3, 1), 0, 7)],
]


def land(spark, path, rows):
    spark.createDataFrame([(*r, None) for r in rows], MESSAGE).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    for rows in BATCHES:
        land(spark, path, rows)
    return path


def state(spark, root):
    dead = {(r.key, r.reason) for r in spark.read.parquet(f"{root}/dead_letters").collect()}
    view = {r.key: r.value for r in message_log(spark, root).rebuild().collect()}
    rows = sorted((r.station_id, r.s_no) for r in read_archive(spark, f"{root}/archive").collect())
    return dead, view, rows


DEAD = {("2", "not an envelope"), ("2", "unparsable"), ("3", "not an envelope")}
VIEW = {
    "1": message(1, 3, 70),
    "unknown_station": message(5, 1, 90),
    "2": '{"station_id":2,',  # content of an envelope is not read here
    "3": message(3, 1),
}
ROWS = [(1, 1), (1, 2), (1, 3), (3, 1), (5, 1)]


def test_ingest_and_restart(spark, landing, tmp_path):
    root = str(tmp_path / "out")

    def run():
        stream = stream_files(spark, landing, MESSAGE, maxFilesPerTrigger=1)
        query = start_ingest(stream, root, f"{root}/checkpoint", DRAIN)
        query.awaitTermination()
        return query

    run()
    assert state(spark, root) == (DEAD, VIEW, ROWS)
    # Nothing new: nothing changes.
    run()
    assert state(spark, root) == (DEAD, VIEW, ROWS)
    # Messages that arrive while the query is down are read after the restart.
    land(spark, landing, [("3", message(3, 2), 0, 8)])
    run()
    assert state(spark, root) == (DEAD, VIEW | {"3": message(3, 2)}, sorted([*ROWS, (3, 2)]))


def test_new_checkpoint_replaces_nothing(spark, landing, tmp_path):
    root = str(tmp_path / "out")
    for checkpoint in ("first", "second"):
        stream = stream_files(spark, landing, MESSAGE, maxFilesPerTrigger=1)
        start_ingest(stream, root, f"{root}/{checkpoint}", DRAIN).awaitTermination()
        message_log(spark, root).compact()
    dead, view, rows = state(spark, root)
    assert (dead, view, rows) == (DEAD, VIEW, sorted(ROWS * 2))


def test_batch_that_runs_twice(spark, tmp_path):
    root = str(tmp_path / "out")
    for batch in (0, 1, 1, 2):
        rows = spark.createDataFrame([(*r, None) for r in BATCHES[batch]], MESSAGE)
        split_batch(rows, batch, root, gather=batch != 2, rows_per_file=1)
    assert state(spark, root) == (DEAD, VIEW, ROWS)


def test_rejected_rows_can_go_elsewhere(spark, tmp_path):
    got = []
    batch = spark.createDataFrame([(*r, None) for r in BATCHES[1]], MESSAGE)
    split_batch(batch, 7, str(tmp_path), reject=lambda rows, i: got.append((i, rows.count())))
    assert got == [(7, 2)]
    assert not (tmp_path / "dead_letters").exists()


def test_later_arrival_wins_whatever_its_offset(spark, tmp_path):
    root, path = str(tmp_path / "out"), str(tmp_path / "landing")
    run = lambda checkpoint: start_ingest(
        stream_files(spark, path, MESSAGE, maxFilesPerTrigger=1), root, f"{root}/{checkpoint}", DRAIN
    ).awaitTermination()
    view = lambda: {r.key: json.loads(r.value)["s_no"] for r in message_log(spark, root).rebuild().collect()}
    # The key moves to a partition whose offsets are lower, then the topic is made anew.
    land(spark, path, [("1", message(1, 1), 0, 900), (None, message(2, 1), 0, 901), (None, message(2, 2), 1, 3)])
    run("first")
    assert view() == {"1": 1, "unknown_station": 2}
    land(spark, path, [("1", message(1, 2), 3, 5)])
    run("first")
    assert view() == {"1": 2, "unknown_station": 2}
    path = str(tmp_path / "anew")
    land(spark, path, [("1", message(1, 3), 0, 0)])
    run("second")
    assert view() == {"1": 3, "unknown_station": 2}
    message_log(spark, root).compact()
    assert view() == {"1": 3, "unknown_station": 2}


def test_record_time_comes_first_inside_a_batch(spark, tmp_path):
    at = datetime.datetime(2024, 5, 1)
    rows = [("1", message(1, 1), 0, 9, at), ("1", message(1, 2), 1, 2, at + datetime.timedelta(seconds=1)), ("1", message(1, 3), 2, 50, None)]
    split_batch(spark.createDataFrame(rows, MESSAGE), 0, str(tmp_path))
    assert json.loads(message_log(spark, str(tmp_path)).rebuild().first().value)["s_no"] == 2


def test_default_triggers(spark, landing, tmp_path):
    alerts = start_alerts(stream_files(spark, landing, MESSAGE), f"{tmp_path}/c1", path=f"{tmp_path}/alerts")
    ingest = start_ingest(stream_files(spark, landing, MESSAGE), f"{tmp_path}/out", f"{tmp_path}/c2")
    try:
        alerts.processAllAvailable()
        ingest.processAllAvailable()
        land(spark, landing, [("9", message(9, 1, 99), 0, 9)])
        alerts.processAllAvailable()
        assert spark.read.parquet(f"{tmp_path}/alerts").count() == 3
        # The ingest gathers for a minute before its next batch.
        assert state(spark, f"{tmp_path}/out") == (DEAD, VIEW, ROWS)
    finally:
        alerts.stop()
        ingest.stop()


def test_alerts_need_one_target(spark, landing):
    for targets in ({}, {"path": "x", "kafka": {"topic": "y"}}):
        with pytest.raises(ValueError):
            start_alerts(stream_files(spark, landing, MESSAGE), "c", **targets)


def test_alerts(spark, landing, tmp_path):
    root = str(tmp_path / "alerts")
    for _ in range(2):
        stream = stream_files(spark, landing, MESSAGE, maxFilesPerTrigger=1)
        start_alerts(stream, f"{root}/checkpoint", path=f"{root}/out", trigger=DRAIN).awaitTermination()
    rows = spark.read.parquet(f"{root}/out").collect()
    assert {(r.key, json.loads(r.value)["humidity"]) for r in rows} == {(None, 90), ("1", 71)}
    assert len(rows) == 2


def test_latest_over_batches(spark, tmp_path):
    path, root = str(tmp_path / "landing"), str(tmp_path / "latest")
    rows = spark.range(4_000).select(
        F.concat(F.lit("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("key"),
        F.concat(F.lit("v"), F.col("id")).alias("value"),
        F.col("id").alias("version"),
    )
    rows.repartition(4).write.parquet(path)
    log = ChangeLog(spark, f"{root}/log")
    stream = stream_files(spark, path, LOG, maxFilesPerTrigger=1)
    start_latest(stream, log, f"{root}/checkpoint", DRAIN).awaitTermination()
    assert len(log.positions()) >= 4
    want = sorted(map(tuple, latest_per_key(rows, "key", "version").collect()))
    assert sorted(map(tuple, log.rebuild().select("key", "value", "version").collect())) == want


def test_single_file_as_stream(spark, landing):
    rows = spark.read.schema(MESSAGE).parquet(landing)
    one = rows.inputFiles()[0]
    stream = stream_files(spark, one, MESSAGE)
    query = stream.writeStream.format("memory").queryName("one").trigger(**DRAIN).start()
    query.awaitTermination()
    assert spark.table("one").count() in {len(b) for b in BATCHES}


def test_feed_as_stream(spark, tmp_path):
    path = tmp_path / "feed"
    path.mkdir()
    for i in range(3):
        (path / f"{i}.json").write_text(
            json.dumps({"current": {"temperature_2m": 20.9 + i, "relative_humidity_2m": 60 + i}}) + "\n"
        )
    readings = adapt_feed(
        stream_documents(spark, str(path)), "value", F.lit(11), F.lit(1714521600), F.lit(1)
    )
    query = readings.writeStream.format("memory").queryName("feed").trigger(**DRAIN).start()
    query.awaitTermination()
    rows = {(r.humidity, r.temperature, r.wind_speed) for r in spark.table("feed").collect()}
    assert rows == {(60, 20, 0), (61, 21, 0), (62, 22, 0)}
