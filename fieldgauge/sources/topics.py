"""Keyed topics: Kafka, or a folder of message files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BATCH_DELAY, BATCH_ROWS, MESSAGE
from .storage import Folder


def kafka_options(servers: str, topic: str, starting: str, **more: object) -> dict[str, str]:
    """`starting` is "latest" for the ingest and "earliest" for the alerts; it counts only
    on the first run, afterwards the checkpoint says where to go on."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    return options | {name: str(value) for name, value in more.items()}


def as_messages(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        "timestamp",
    )


def stream_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **more: object
) -> DataFrame:
    """Unbounded messages of a Kafka topic; bound a batch with maxOffsetsPerTrigger.

    A batch waits for BATCH_ROWS messages, or BATCH_DELAY, unless the options
    minOffsetsPerTrigger and maxTriggerDelay say otherwise.
    """
    waiting = {"minOffsetsPerTrigger": BATCH_ROWS, "maxTriggerDelay": BATCH_DELAY}
    options = kafka_options(servers, topic, starting, **(waiting | more))
    return as_messages(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, servers: str, topic: str, **more: object) -> DataFrame:
    """All messages now in a Kafka topic."""
    options = kafka_options(servers, topic, "earliest", **more)
    return as_messages(spark.read.format("kafka").options(**options).load())


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Publish the key and value columns; equal keys keep their order in one partition."""
    (
        df.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType = MESSAGE, after: int | None = None, **options: object
) -> DataFrame:
    """A folder of Parquet files, or one file, as a stream. With `after` only files written
    later than that many milliseconds; older ones are not opened."""
    reader = spark.readStream.schema(schema)
    if not Folder(spark, path).is_folder():
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    rows = reader.options(**{k: str(v) for k, v in options.items()}).parquet(path)
    if after is not None:
        written = F.col("_metadata.file_modification_time")
        rows = rows.where(written > F.timestamp_millis(F.lit(after))).select(*schema.names)
    return rows


def start_mark(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Where a stream of files begins that is to start at the tail, like `latest` of a topic.

    Asked the first time it is the newest file that is there; the answer is kept beside the
    checkpoint, so that after a restart the checkpoint alone decides what was read, and
    files that came in between are not skipped.
    """
    folder, _, name = checkpoint.rstrip("/").rpartition("/")
    kept, name = Folder(spark, folder), f"{name}.start"
    if not kept.exists(name):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        newest = files.agg(F.max(F.unix_millis("modificationTime"))).first()[0]
        kept.create_text(name, str(newest or 0))
    return int(kept.read_text(name))
