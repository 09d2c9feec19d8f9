"""Registered queries that run a stream over the events until it is drained.

The events are dealt into parts by their number, and each part is landed as the files of
one batch, so that every query runs over several batches and its state is carried on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.messages import classify, readings
from ..operators.ordering import estimated_bytes, offset_block
from ..schema import BATCH_ROWS, MESSAGE
from ..session import scratch
from ..sources.archive import compact_archive, read_archive, with_partitions, write_archive
from ..sources.change_log import ChangeLog
from ..sources.topics import start_mark, stream_files
from ..streaming.events import RunAudit, StatusWindows, first_arrivals
from ..streaming.ingest import DRAIN, POLL, message_log, start_alerts, start_ingest, start_latest
from ..streaming.state import batches_done, latest_changes, latest_view, state_partitions
from .tables import as_messages, messages, over_partitions, table

# Batches of a query, and bytes of a landed file. A file of one row group is read by one task,
# and a megabyte of events is about a second of making and parsing messages.
PARTS = 4
FILE_BYTES = 2 * 1024**2
# Bytes of events whose state shares a partition, of which there is at least one per core.
STATE_BYTES = 16 * 1024**2


def parts(spark: SparkSession, d: str, make: Callable[[DataFrame, Column], DataFrame] | None = None) -> Iterator[DataFrame]:
    """The events dealt into PARTS equal ranges of their numbers, in order. `make` turns the
    events and the number of their part into other rows with a column `part`."""
    events = table(spark, d, "events")
    count = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    bounds = [-(-number * count // PARTS) for number in range(PARTS + 1)]
    rows = make(events, F.floor(F.col("event_id") * PARTS / F.lit(count))) if make else None
    for number, (first, stop) in enumerate(zip(bounds, bounds[1:])):
        if rows is None:
            # A range of numbers reaches the scan.
            yield events.where((F.col("event_id") >= first) & (F.col("event_id") < stop))
        else:
            yield rows.where(F.col("part") == number).drop("part")


def land(part: DataFrame, path: str) -> int:
    """Add the files of one part to a folder; returns how many there are."""
    # The estimate is that of all events, since it does not follow the filter of a part.
    files = max(1, -(-estimated_bytes(part) // (PARTS * FILE_BYTES)))
    cores = part.sparkSession.sparkContext.defaultParallelism
    if 1 < files and cores < 2 * files:
        # So that no core waits for the last few; at most twice as many.
        files = -(-files // cores) * cores
    part.repartition(files).write.mode("append").parquet(path)
    return files


def event_stream(spark: SparkSession, d: str, **options: object) -> DataFrame:
    """The events as a stream of which a batch reads one part."""
    path = scratch(spark, "landing")
    files = max(land(part, path) for part in parts(spark, d))
    return stream_files(spark, path, table(spark, d, "events").schema, maxFilesPerTrigger=files, **options)


def bounded_state(spark: SparkSession, d: str) -> AbstractContextManager[None]:
    """State of queries over the events in as many partitions as their size needs."""
    size = estimated_bytes(table(spark, d, "events"))
    return state_partitions(spark, max(spark.sparkContext.defaultParallelism, -(-size // STATE_BYTES)))


def _ingest(spark: SparkSession, d: str, deal=lambda messages: messages) -> str:
    root = scratch(spark, "ingest")
    start_ingest(deal(as_messages(event_stream(spark, d))), root, f"{root}/checkpoint", DRAIN).awaitTermination()
    return root


def stream_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType(MESSAGE.fields + [T.StructField("reason", T.StringType())])
    root = _ingest(spark, d)
    return (
        spark.read.schema(schema)
        .parquet(f"{root}/dead_letters")
        .select("key", "value", "offset", "reason")
    )


def stream_archive(spark: SparkSession, d: str) -> DataFrame:
    return read_archive(spark, f"{_ingest(spark, d)}/archive")


def stream_view(spark: SparkSession, d: str) -> DataFrame:
    return message_log(spark, _ingest(spark, d)).rebuild().select("key", "value", "offset")


def stream_view_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The view of messages from several partitions, some without a key."""
    log = message_log(spark, _ingest(spark, d, over_partitions))
    return log.rebuild().select("key", "value", "partition", "offset")


def archive_compaction(spark: SparkSession, d: str) -> DataFrame:
    """The archive of three ingested batches, then merged to few files."""
    root = scratch(spark, "ingest")
    rows = with_partitions(readings(classify(messages(spark, d))))
    for batch in range(3):
        write_archive(rows.filter(F.col("s_no") % 3 == batch), f"{root}/archive", batch=f"main-{batch}")
    compact_archive(spark, f"{root}/archive", f"{root}/merged")
    merged = read_archive(spark, f"{root}/merged")
    before, after = (
        spark.read.parquet(f"{root}/{name}").select(F.count_distinct("_metadata.file_path")).first()[0]
        for name in ("archive", "merged")
    )
    return merged.withColumn("fewer_files", F.lit(after < before))


LATEST = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    root = scratch(spark, "latest")
    log = ChangeLog(spark, f"{root}/log", LATEST, "user_id", "event_id")
    stream = event_stream(spark, d)
    with bounded_state(spark, d):
        start_latest(stream, log, f"{root}/checkpoint", DRAIN).awaitTermination()
    return log.rebuild()


def _latest_by_parts(spark: SparkSession, d: str) -> str:
    """The checkpoint of a query that was started anew for each part."""
    root, landing = scratch(spark, "latest"), scratch(spark, "landing")
    log = ChangeLog(spark, f"{root}/log", LATEST, "user_id", "event_id")
    for part in parts(spark, d):
        land(part, landing)
        stream = stream_files(spark, landing, table(spark, d, "events").schema)
        with bounded_state(spark, d):
            start_latest(stream, log, f"{root}/checkpoint", DRAIN).awaitTermination()
    return f"{root}/checkpoint"


def state_view(spark: SparkSession, d: str) -> DataFrame:
    """The latest rows as the state has them after each batch, read without the sink."""
    checkpoint = _latest_by_parts(spark, d)
    views = [
        latest_view(spark, checkpoint, batch).withColumn("after_batch", F.lit(batch).cast("bigint"))
        for batch in batches_done(spark, checkpoint)
    ]
    whole = views[0]
    for view in views[1:]:
        whole = whole.unionByName(view)
    return whole


def state_changes(spark: SparkSession, d: str) -> DataFrame:
    """The keys whose latest row changed in each batch, as the state logged them."""
    checkpoint = _latest_by_parts(spark, d)
    return latest_changes(spark, checkpoint, 0).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def with_repeats(events: DataFrame, part: Column) -> DataFrame:
    """Events as they arrive from producers that send again: some twice in a batch, some
    in the next batch too, some in the next batch with a time of four days later."""
    rows = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("at"), part.alias("part"))
    kind = F.col("event_id") % 10
    again = rows.where(kind < 3).select(
        "event_id",
        "user_id",
        F.when(kind == 2, F.col("at") + F.expr("interval 4 days")).otherwise(F.col("at")).alias("at"),
        (F.col("part") + F.when(kind == 0, 0).otherwise(1)).alias("part"),
    )
    return rows.unionByName(again.where(F.col("part") < PARTS))


def stream_first_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Each event once, whatever was sent again within a day; the query is started anew for
    each part."""
    root, landing = scratch(spark, "arrivals"), scratch(spark, "landing")
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("at", T.TimestampType()),
        ]
    )
    for part in parts(spark, d, with_repeats):
        land(part, landing)
        stream = first_arrivals(stream_files(spark, landing, schema), "event_id", "at", "1 day")
        with bounded_state(spark, d):
            (
                stream.writeStream.format("parquet")
                .option("path", f"{root}/out")
                .option("checkpointLocation", f"{root}/checkpoint")
                .trigger(**DRAIN)
                .start()
                .awaitTermination()
            )
    found = spark.read.schema(schema).parquet(f"{root}/out")
    return found.select("event_id", "user_id", F.unix_micros("at").alias("at_micros"))


def stream_status_windows(spark: SparkSession, d: str) -> DataFrame:
    """Share of each status per station and day; the last days are closed in the end."""
    windows = StatusWindows(
        spark, scratch(spark, "windows"), "station_id", "status", "1 day", "6 hours",
        T.StructType([T.StructField("station_id", T.LongType()), T.StructField("status", T.StringType())]),
    )
    stream = event_stream(spark, d).select(
        (F.col("user_id") % 10 + 1).alias("station_id"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("at")
    )
    with bounded_state(spark, d):
        windows.start(stream, "at", DRAIN).awaitTermination()
        windows.close()
        windows.start(stream, "at", DRAIN).awaitTermination()
    return windows.read().select(
        F.unix_seconds("window.start").alias("begins"), "station_id", "status", "n", F.round("pct", 4).alias("pct")
    )


def stream_sequence_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of numbers that fall every thousand events and are now and then repeated or
    left out, audited batch by batch."""
    audit = RunAudit(
        spark, scratch(spark, "runs"), T.StructField("user_id", T.LongType()), "s_no", ["event_id"],
        offset_block(F.col("event_id"), 1000),
    )
    stream = event_stream(spark, d).select("user_id", "event_id", sequence_number().alias("s_no"))
    audit.start(stream, f"{audit.root}/checkpoint", DRAIN).awaitTermination()
    audit.compact()
    return audit.read()


def sequence_number() -> Column:
    """Two events share a number, and every thousand and first begins anew."""
    return F.floor(F.pmod(F.col("event_id"), F.lit(1001)) / 2)


def _tail(spark: SparkSession, d: str, from_tail: bool) -> DataFrame:
    """Events of a query that starts when half of them have landed, and stops twice."""
    root, landing = scratch(spark, "tail"), scratch(spark, "landing")
    schema = table(spark, d, "events").schema
    for number, part in enumerate(parts(spark, d)):
        land(part, landing)
        if number == 0:
            continue
        after = start_mark(spark, landing, f"{root}/checkpoint") if from_tail else None
        stream = stream_files(spark, landing, schema, after).select("event_id", "user_id", "event_type")
        (
            stream.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**DRAIN)
            .start()
            .awaitTermination()
        )
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def stream_from_tail(spark: SparkSession, d: str) -> DataFrame:
    """What landed after the first start: the last two parts of four."""
    return _tail(spark, d, True)


def stream_from_start(spark: SparkSession, d: str) -> DataFrame:
    """All of it, the parts before the first start too."""
    return _tail(spark, d, False)


def stream_restarted(spark: SparkSession, d: str) -> DataFrame:
    """The archive of an ingest that polls, is stopped in the middle, and drains the rest
    when it is started again; files of at most so many rows. Each row says whether its file
    keeps to that."""
    root, landing = scratch(spark, "ingest"), scratch(spark, "landing")
    start = lambda trigger: start_ingest(
        as_messages(stream_files(spark, landing, table(spark, d, "events").schema)),
        root, f"{root}/checkpoint", trigger, rows_per_file=BATCH_ROWS,
    )
    landed = parts(spark, d)
    land(next(landed), landing)
    polling = start(POLL)
    polling.processAllAvailable()
    land(next(landed), landing)
    polling.processAllAvailable()
    polling.stop()
    for part in landed:
        land(part, landing)
    start(DRAIN).awaitTermination()
    rows = read_archive(spark, f"{root}/archive").withColumn("_file", F.col("_metadata.file_path"))
    sizes = rows.groupBy("_file").agg((F.count(F.lit(1)) <= BATCH_ROWS).alias("bounded"))
    return rows.join(sizes, "_file").drop("_file")


def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    root = scratch(spark, "alerts")
    start_alerts(
        as_messages(event_stream(spark, d)), f"{root}/checkpoint", path=f"{root}/alerts", trigger=DRAIN
    ).awaitTermination()
    return (
        spark.read.schema(MESSAGE).parquet(f"{root}/alerts").select("offset", "key", "value")
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_dead_letters,
        stream_archive,
        stream_view,
        stream_view_partitions,
        stream_latest,
        stream_alerts,
        state_view,
        state_changes,
        stream_first_arrivals,
        stream_status_windows,
        stream_sequence_runs,
        stream_from_tail,
        stream_from_start,
        stream_restarted,
        archive_compaction,
    )
}
