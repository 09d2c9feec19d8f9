"""Streaming queries: ingest with dead letters, change log and archive; alerts; latest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import rain_alerts
from ..operators.latest import latest_per_key
from ..operators.messages import (
    NOT_ENVELOPE,
    classify,
    dead_letters,
    readings,
    with_default_key,
)
from ..schema import ARRIVAL, ARRIVALS, BATCH_DELAY, POLL_INTERVAL
from ..sources.archive import with_partitions, write_archive
from ..sources.change_log import ChangeLog
from ..sources.storage import Folder

# Name of the only writer, where there is no checkpoint.
MAIN = "main"
# Drain everything that has arrived, in batches, then stop.
DRAIN = {"availableNow": True}
# For alerts: look for messages all the time.
POLL = {"processingTime": POLL_INTERVAL}
# For what writes files: one batch per interval. A topic that is polled more often should
# carry a least number of messages per batch, as `topics.stream_topic` does.
GATHER = {"processingTime": BATCH_DELAY}


def message_log(spark: SparkSession, root: str) -> ChangeLog:
    """The log that the ingest below `root` writes; its `rebuild()` is the latest view."""
    return ChangeLog(spark, f"{root}/log", ARRIVALS, "key", ARRIVAL)


def split_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    writer: str = MAIN,
    epoch: int = 0,
    reject: Callable[[DataFrame, int], None] | None = None,
    **archive_options: object,
) -> None:
    """Send one batch of messages to its three tables below `root`.

    dead_letters: whatever is not a complete message, with the reason.
    log:          latest value per key; any envelope counts, its content is not read.
    archive:      complete messages, flat.

    Every table is written per writer and batch id, so a batch that runs twice leaves
    one copy, and a query that starts over with a new checkpoint replaces nothing.
    `epoch` is greater for writers that started later. `reject` takes the dead letters
    instead of the table, to send them to a topic.
    `archive_options` are those of `write_archive`.
    """

    def to_table(rows: DataFrame, batch_id: int) -> None:
        # Few rows from many tasks: rebalanced, so that they do not make as many files.
        rows.hint("rebalance").write.mode("overwrite").parquet(
            f"{root}/dead_letters/w={writer}/b={batch_id}"
        )

    classified = classify(with_default_key(batch)).persist()
    try:
        rejected = dead_letters(classified, "key", "value", "partition", "offset", "timestamp")
        (reject or to_table)(rejected, batch_id)
        accepted = classified.filter(~classified.reason.eqNullSafe(NOT_ENVELOPE))
        message_log(batch.sparkSession, root).append(accepted, batch_id, epoch)
        write_archive(
            with_partitions(readings(classified)),
            f"{root}/archive",
            batch=f"{writer}-{batch_id}",
            **archive_options,
        )
    finally:
        classified.unpersist()


def writer_of(batch: DataFrame, checkpoint: str) -> str:
    """Name of the query that owns a checkpoint; stays the same over restarts."""
    return Folder(batch.sparkSession, checkpoint).read_json("metadata")["id"]


def epoch_of(batch: DataFrame, checkpoint: str) -> int:
    """When a checkpoint was begun, in milliseconds: later ones count as later."""
    return Folder(batch.sparkSession, checkpoint).modified("metadata")


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or GATHER))
        .start()
    )


def start_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options: object,
) -> StreamingQuery:
    """Route a stream of messages; a restart goes on where the checkpoint ends.

    `options` are those of `split_batch`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        split_batch(batch, batch_id, root, writer_of(batch, checkpoint), epoch_of(batch, checkpoint), **options)

    return start_batches(messages, write, checkpoint, trigger)


def start_alerts(
    messages: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    trigger: dict | None = None,
    **paths: object,
) -> StreamingQuery:
    """Write the alert of each message over the threshold to Parquet files or a topic."""
    if (path is None) == (kafka is None):
        raise ValueError("alerts go to a path or to a topic: give one of the two")
    alerts = rain_alerts(messages, **paths)
    if kafka:
        writer = alerts.select("key", "value").writeStream.format("kafka").options(**kafka)
    else:
        writer = alerts.writeStream.format("parquet").option("path", path)
    return (
        writer.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or POLL))
        .start()
    )


def start_latest(
    stream: DataFrame,
    log: ChangeLog,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the latest row per key in state and log the keys that changed.

    State holds one row per key; keys never expire. `log.rebuild()` is the view.
    """
    latest = latest_per_key(stream.select(*log.schema.names), log.key, log.version)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, batch_id, epoch_of(batch, checkpoint), reduce=False)

    return start_batches(latest, write, checkpoint, trigger, "update")
