"""What a streaming query holds in its state, read as tables from its checkpoint.

The state is there after every batch, without a sink: the rows as they were after a batch,
and the rows that changed between two batches. Reading takes place beside the running
query and never disturbs it. Batches that the query has cleaned up (all but the last
hundred, by Spark's default) cannot be asked for any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import Folder

SHUFFLES = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries that run inside begin their state with `most` partitions, or fewer if the
    session has fewer shuffle partitions. A checkpoint keeps the number it began with.

    A partition is a task and a store of its own in every batch, whatever it holds.
    """
    before = spark.conf.get(SHUFFLES)
    spark.conf.set(SHUFFLES, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES, before)


def batches_done(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the batches that a query has finished."""
    names = Folder(spark, f"{checkpoint.rstrip('/')}/commits").names()
    return sorted(int(name) for name in names if name.isdigit())


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: number, name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(
    spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0
) -> DataFrame:
    """`key`, `value`, `partition_id` of an operator's state after a batch, the last if none
    is named."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def state_changes(
    spark: SparkSession, checkpoint: str, first: int, last: int | None = None, operator: int = 0
) -> DataFrame:
    """`batch_id`, `change_type` (update or delete), `key`, `value` of what changed from
    batch `first` to batch `last`, both included."""
    reader = (
        spark.read.format("statestore")
        .option("operatorId", operator)
        .option("readChangeFeed", True)
        .option("changeStartBatchId", first)
    )
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load(checkpoint)


def _view(rows: DataFrame, *more: str) -> DataFrame:
    """Flat columns of the state of `latest_per_key`: its value is one struct of columns."""
    best = rows.schema["value"].dataType.names[0]
    keys = [F.col(f"key.{name}").alias(name) for name in rows.schema["key"].dataType.names]
    return rows.select(*more, *keys, f"value.{best}.*")


def latest_view(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The latest row per key that `start_latest` keeps, as it was after a batch."""
    return _view(state_rows(spark, checkpoint, batch))


def latest_changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None) -> DataFrame:
    """The rows that became the latest of their keys in these batches, with `batch_id`."""
    rows = state_changes(spark, checkpoint, first, last).where("change_type = 'update'")
    return _view(rows, "batch_id")
