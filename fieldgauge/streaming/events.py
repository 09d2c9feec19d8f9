"""Streams with event time: repeats and late rows, windows, and audits over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import audit
from ..operators.audit import RUN
from ..operators.latest import latest_per_key
from ..operators.ordering import keep
from ..sources.change_log import BATCH, EPOCH, ChangeLog
from ..sources.storage import Folder
from .ingest import epoch_of, start_batches
from .state import state_rows

# ---- repeats and late rows


def first_arrivals(stream: DataFrame, key: str | list[str], at: str, delay: str) -> DataFrame:
    """The first row of each key among those that come within `delay` of it.

    State holds one row per key and forgets it once the watermark, the greatest time `at`
    of the batches before less `delay`, is `delay` past that row. A repeat that comes later
    and with a new time counts as a row of its own; one with its old time is late by then.
    Rows at or before the watermark are left out, and so are rows without a time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return stream.where(F.col(at).isNotNull()).withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


# ---- shares of each status over windows

MARK = T.StructType([T.StructField("at", T.TimestampType())])


def window_counts(stream: DataFrame, marks: DataFrame, station: str, status: str, at: str, window: str, delay: str) -> DataFrame:
    """(window, station, status, n) of each window, once the watermark has passed its end.

    `marks` is a stream of times that move the watermark on and count nothing. They go
    through the same aggregate, since a filter before it would take them away.
    """
    rows = stream.select(F.col(at).alias("at"), F.col(station).alias(station), F.col(status).alias(status), F.lit(1).alias("_n"))
    both = rows.unionByName(marks.select("at", F.lit(0).alias("_n")), allowMissingColumns=True)
    return (
        both.withWatermark("at", delay)
        .groupBy(F.window("at", window).alias("window"), station, status)
        .agg(F.sum("_n").alias("n"))
        .where("n > 0")
    )


class StatusWindows:
    """Share of each status per station and window of event time, below `root`.

        root/shares/batch=<n>/   windows that closed in a batch: window, station, status, n, pct
        root/marks/              times that close windows when no more rows come
        root/checkpoint/
    """

    def __init__(
        self, spark: SparkSession, root: str, station: str, status: str, window: str, delay: str, types: T.StructType
    ):
        """`types` has the types of station and status."""
        self.spark, self.root = spark, root.rstrip("/")
        self.station, self.status, self.window, self.delay, self.types = station, status, window, delay, types
        self._marks = Folder(spark, f"{self.root}/marks")
        if not self._marks.exists():
            spark.createDataFrame([], MARK).write.parquet(self._marks.path)

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def start(self, stream: DataFrame, at: str, trigger: dict | None = None) -> StreamingQuery:
        """Count the rows of a stream. A window is written once, when it has closed; a batch
        that runs again replaces its windows."""
        marks = self.spark.readStream.schema(MARK).parquet(self._marks.path)
        counts = window_counts(stream, marks, self.station, self.status, at, self.window, self.delay)

        def write(batch: DataFrame, batch_id: int) -> None:
            # All statuses of a station and window close in the same batch.
            shares = audit.status_share(batch, ["window", self.station], self.status, F.sum("n"))
            shares.withColumn("batch", F.lit(batch_id).cast("bigint")).write.partitionBy("batch").option(
                "partitionOverwriteMode", "dynamic"
            ).mode("overwrite").parquet(f"{self.root}/shares")

        return start_batches(counts, write, self.checkpoint, trigger)

    def close(self) -> None:
        """Let the next run close all windows that are open now, the last one included.

        Rows that come afterwards and belong to them are late. Call it between runs.
        """
        ends = state_rows(self.spark, self.checkpoint).where("value.sum > 0").agg(F.max("key.window.end").alias("last"))
        mark = ends.select((F.col("last") + F.expr(f"interval {self.delay}")).alias("at")).where("at IS NOT NULL")
        mark.coalesce(1).write.mode("append").parquet(self._marks.path)

    def read(self) -> DataFrame:
        """window (start, end), station, status, n, pct of all closed windows."""
        bounds = T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())])
        schema = T.StructType(
            [
                T.StructField("window", bounds),
                self.types[self.station],
                self.types[self.status],
                T.StructField("n", T.LongType()),
                T.StructField("pct", T.DoubleType()),
            ]
        )
        if not Folder(self.spark, f"{self.root}/shares").exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/shares").select(*schema.names)


# ---- lost messages


class RunAudit:
    """Sequence audit of a stream, batch by batch, without reading a message twice.

        root/closed/batch=<n>/   runs that ended in a batch
        root/open/               change log of the run that is open at each station

    A batch is reduced to pieces of runs; the open run of each of its stations goes before
    them as one more piece, so a run that crosses batches goes on where it was. What a
    batch reads of earlier ones is one row for each of its stations.
    """

    def __init__(
        self, spark: SparkSession, root: str, station: T.StructField, seq: str, order_by: list[str],
        block: Column | None = None,
    ):
        """`order_by` and `block` are those of `audit.sequence_runs`; the order is that
        inside a batch, batches come one after the other."""
        self.spark, self.root = spark, root.rstrip("/")
        self.station, self.seq, self.order_by, self.block = station, seq, order_by, block
        self.runs = T.StructType([station, *RUN.fields])
        position = T.StructType([*self.runs.fields, EPOCH, BATCH])
        self.open = ChangeLog(spark, f"{self.root}/open", position, station.name, ["epoch", "batch"])

    def add(self, batch: DataFrame, batch_id: int, epoch: int = 0) -> None:
        """Audit one batch; the same batch again replaces what it left."""
        name = self.station.name
        before = max((p for p in [*self.open.positions(), *self.open.snapshots()] if p < (epoch, batch_id)), default=None)
        earlier = self.open.rebuild(before) if before else self.spark.createDataFrame([], self.open.schema)
        # All that is needed of the messages; they are read once.
        pieces = audit.sequence_pieces(batch, name, self.seq, self.order_by, self.block)
        pieces = keep(pieces) if self.block is None else pieces.persist()
        try:
            # Of the stations of the batch only; the others' runs stay as they are.
            known = earlier.select(*self.runs.names).join(pieces.select(name).distinct(), name, "left_semi")
            runs = audit.merge_pieces(pieces, name, known)
            runs = runs.select(*[F.col(f.name).cast(f.dataType) for f in self.runs.fields]).persist()
            # The last run of a station is the one that is open.
            newest = latest_per_key(runs, name, "run").select(*self.runs.names)
            at = {"epoch": F.lit(epoch).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")}
            ended = runs.join(newest.select(name, F.col("run").alias("_last")), name).where("run < _last").drop("_last")
            (
                ended.withColumns(at)
                .write.partitionBy("epoch", "batch")
                .option("partitionOverwriteMode", "dynamic")
                .mode("overwrite")
                .parquet(f"{self.root}/closed")
            )
            self.open.append(newest, batch_id, epoch, reduce=False)
            runs.unpersist()
        finally:
            pieces.unpersist()

    def compact(self) -> None:
        """Keep the open runs in one snapshot, but for the newest batch, which may run again."""
        done = self.open.positions()[:-1]
        if done:
            self.open.compact(done[-1])
            self.open.drop_compacted()

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        # Batches are numbered within a checkpoint: a new one begins a new audit.
        return start_batches(
            stream.select(self.station.name, self.seq, *self.order_by),
            lambda batch, batch_id: self.add(batch, batch_id, epoch_of(batch, checkpoint)),
            checkpoint,
            trigger,
        )

    def read(self) -> DataFrame:
        """All runs, ended and open, as `audit.sequence_runs` gives them."""
        still = self.open.rebuild().select(*self.runs.names)
        if not Folder(self.spark, f"{self.root}/closed").exists():
            return still
        ended = self.spark.read.schema(self.runs).parquet(f"{self.root}/closed")
        return ended.select(*self.runs.names).unionByName(still)
