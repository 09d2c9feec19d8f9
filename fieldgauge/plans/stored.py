"""Registered queries that write a table below the shared folder and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import loose_double
from ..functions.times import epoch_seconds
from ..operators import latest
from ..operators.messages import classify, readings, with_default_key, with_validity
from ..session import scratch
from ..sources import archive, exports, feeds
from ..sources.change_log import ChangeLog
from .batch import feed_documents
from .tables import messages, table

EVENT_ROW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _archive(spark: SparkSession, d: str) -> str:
    events = archive.with_partitions(table(spark, d, "events"), epoch_seconds(F.col("ts")))
    path = scratch(spark, "archive")
    archive.write_archive(events.select(*EVENT_ROW.names, "year", "month"), path, "event_type")
    return path


def archive_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return archive.read_archive(spark, _archive(spark, d), EVENT_ROW, "event_type")


def slice_rows(spark: SparkSession, d: str) -> DataFrame:
    part = archive.read_slice(archive_round_trip(spark, d), event_type="view", year=2024, month=1)
    return part.select("event_id", "user_id", "value")


def slice_folder(spark: SparkSession, d: str) -> DataFrame:
    part = archive.read_folder(spark, _archive(spark, d), "view", 2024, 1, EVENT_ROW, "event_type")
    return part.select("event_id", "user_id", "value")


def _view(spark: SparkSession, d: str) -> DataFrame:
    """Latest envelope per key of messages of which many are odd."""
    accepted = with_validity(with_default_key(messages(spark, d))).filter("valid")
    return latest.latest_per_key(accepted, "key", "offset", ["value"])


def snapshot_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "snapshot")
    exports.write_snapshot(_view(spark, d), path)
    return exports.read_snapshot(spark, path)


def snapshot_csv_quoted(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "snapshot-csv")
    exports.write_csv(_view(spark, d), path)
    return exports.read_csv(spark, path)


def export_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "snapshot-json")
    exports.snapshot_json(_view(spark, d)).write.text(path)
    return exports.read_documents(spark, path, "key string, value string")


def index_export(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "documents")
    exports.write_documents(table(spark, d, "events").select(*EVENT_ROW.names), path)
    return exports.read_documents(spark, path, EVENT_ROW)


def feed_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "feed")
    feed_documents(spark, d).select("document").write.text(path)
    current = feeds.read_feed(spark, path).select("current.*")
    numbers = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]
    return current.select("time", *[loose_double(F.col(n)).alias(n) for n in numbers])


LATEST_ROW = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def compact_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Three batches; the first two are compacted, the view is rebuilt from all."""
    events = table(spark, d, "events")
    log = ChangeLog(spark, scratch(spark, "log"), LATEST_ROW, "user_id", "event_id")
    for batch in range(3):
        log.append(events.filter(F.col("event_id") % 3 == batch), batch)
    log.compact(through=(0, 1))
    return log.rebuild()


def compact_files(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot in files of a bounded number of rows; each row says whether its file is."""
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    most = 500
    log = ChangeLog(spark, scratch(spark, "log"), schema, "event_id", "value")
    log.append(table(spark, d, "events"), 0)
    log.compact(rows_per_file=most)
    rows = log.snapshot().select("*", F.col("_metadata.file_path").alias("file"))
    sizes = rows.groupBy("file").agg((F.count("*") <= most).alias("bounded"))
    return rows.join(sizes, "file").select("event_id", "value", "bounded")


def json_document(spark: SparkSession, d: str) -> DataFrame:
    """The view as one JSON object in many part files, read again member by member."""
    path = scratch(spark, "json-document")
    exports.write_json_document(_view(spark, d), path)
    return exports.read_json_document(spark, path)


def clustered_span(spark: SparkSession, d: str) -> DataFrame:
    """Ten users over three days, from an archive clustered by user and second."""
    seconds = epoch_seconds(F.col("ts"))
    events = archive.with_partitions(table(spark, d, "events").withColumn("at", seconds), F.col("at"))
    path = scratch(spark, "clustered")
    archive.write_clustered(events.select("event_id", "user_id", "at", "year", "month"), path, "user_id", "at", page_rows=500)
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("event_id", "user_id", "at")])
    first = 1704412800  # 5 January 2024
    span = archive.read_span(archive.read_clustered(spark, path, schema), (40, 49), (first, first + 3 * 86400 - 1), "user_id", "at")
    return span.select("event_id", "user_id", "at")


def merged_small_files(spark: SparkSession, d: str) -> DataFrame:
    """The archive of three batches after its small files were packed in place."""
    path = scratch(spark, "archive")
    rows = archive.with_partitions(readings(classify(messages(spark, d))))
    for batch in range(3):
        archive.write_archive(rows.filter(F.col("s_no") % 3 == batch), path, batch=f"main-{batch}")
    archive.merge_small_files(spark, path)
    return archive.read_archive(spark, path)


def _event_log(spark: SparkSession, d: str) -> ChangeLog:
    log = ChangeLog(spark, scratch(spark, "log"), LATEST_ROW, "user_id", "event_id")
    log.append(table(spark, d, "events"), 0)
    log.compact()
    return log


def lookup_many(spark: SparkSession, d: str) -> DataFrame:
    """Latest rows of the users who have signed up with a high value."""
    wanted = table(spark, d, "events").where((F.col("event_type") == "signup") & (F.col("value") > 60))
    return latest.lookup_many(_event_log(spark, d).rebuild(), "user_id", wanted)


def lookup_list(spark: SparkSession, d: str) -> DataFrame:
    """Latest rows of a few users, of whom one is not there."""
    return latest.lookup_list(_event_log(spark, d).rebuild(), "user_id", [3, 77, 140, -1])


QUERIES = {
    "slice" if f is slice_rows else f.__name__: f
    for f in (
        archive_round_trip,
        slice_rows,
        slice_folder,
        snapshot_csv,
        snapshot_csv_quoted,
        export_json,
        index_export,
        feed_scan,
        compact_rebuild,
        compact_files,
        json_document,
        clustered_span,
        merged_small_files,
        lookup_many,
        lookup_list,
    )
}
