"""Change log: a Parquet partition for each micro-batch, and snapshots of the latest rows.

    root/batches/epoch=<n>/batch=<n>/   latest row per key of one batch
    root/snapshots/<epoch>.<batch>/     latest row per key of all batches up to that one

Both are ordinary Parquet. A batch that runs again replaces its partition (dynamic
overwrite), a snapshot is a new folder that counts once Spark's writer has finished it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import latest_per_key
from ..schema import LOG, LOG_ROWS_PER_FILE
from .storage import Folder

EPOCH, BATCH = T.StructField("epoch", T.LongType()), T.StructField("batch", T.LongType())
# Distinct keys that the Bloom filter of a row group is made for: about 1.2 bytes for each.
BLOOM_KEYS = 200_000
# Epoch and number of a batch.
Position = tuple[int, int]


class ChangeLog:
    """`version` is the column, or the columns from the most significant on, by which the
    latest row of a key is found. Columns `epoch` and `batch` of the schema are those of
    the partition."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType = LOG,
        key: str = "key",
        version: str | list[str] = "version",
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.version = key, version
        self._batches = Folder(spark, f"{self.root}/batches")
        self._snapshots = Folder(spark, f"{self.root}/snapshots")

    def append(self, df: DataFrame, batch_id: int, epoch: int = 0, reduce: bool = True) -> None:
        """Write one batch; the same batch again replaces it.

        Values that are no longer the latest inside the batch cannot be read by anyone,
        so they are left out, unless the caller says that keys are unique already.
        """
        at = {"epoch": F.lit(epoch).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")}
        rows = df.withColumns({name: value for name, value in at.items() if name in self.schema.names})
        rows = rows.select(*self.schema.names)
        if reduce:
            rows = latest_per_key(rows, self.key, self.version)
        (
            self._with_filter(rows.withColumns(at).write)
            .partitionBy("epoch", "batch")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(self._batches.path)
        )

    def _with_filter(self, writer: DataFrameWriter) -> DataFrameWriter:
        """With a Bloom filter of the keys in each row group, so that a look-up of few keys
        skips those groups that only surround them."""
        name = "parquet.bloom.filter"
        return writer.option(f"{name}.enabled#{self.key}", True).option(f"{name}.expected.ndv#{self.key}", BLOOM_KEYS)

    def positions(self) -> list[Position]:
        """Epoch and number of all batches, in order."""
        number = lambda name: int(name.partition("=")[2])
        return sorted(
            (number(epoch), number(batch))
            for epoch in self._batches.names()
            if epoch.startswith("epoch=")
            for batch in Folder(self.spark, f"{self._batches.path}/{epoch}").names()
        )

    def batches(self, after: Position | None = None, through: Position | None = None) -> DataFrame:
        """Rows of the batches in a range; partitions outside it are not read."""
        inner = [f for f in self.schema.fields if f.name not in ("epoch", "batch")]
        whole = T.StructType([*inner, EPOCH, BATCH])
        if not self._batches.exists():
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).parquet(self._batches.path)
        if after is not None:
            rows = rows.where(~_up_to(after))
        return rows if through is None else rows.where(_up_to(through))

    def snapshots(self) -> list[Position]:
        """The batches that finished snapshots reach to, in order."""
        names = (n for n in self._snapshots.names() if self._snapshots.exists(n, "_SUCCESS"))
        return sorted(tuple(map(int, n.split("."))) for n in names)

    def snapshot(self, at: Position | None = None) -> DataFrame:
        """Rows of a snapshot, the newest if none is named."""
        at = at or max(self.snapshots(), default=None)
        if at is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self._snapshots.path}/{at[0]}.{at[1]}")

    def rebuild(self, through: Position | None = None) -> DataFrame:
        """The latest view: the newest snapshot merged with the batches after it; with
        `through` as it was after that batch, as long as nothing older was dropped."""
        at = max((s for s in self.snapshots() if through is None or s <= through), default=None)
        rows = self.batches(at, through).select(*self.schema.names)
        if at is not None:
            rows = rows.unionByName(self.snapshot(at))
        return latest_per_key(rows, self.key, self.version).select(*self.schema.names)

    def compact(self, through: Position | None = None, rows_per_file: int = LOG_ROWS_PER_FILE) -> Position | None:
        """Write the latest rows as a new snapshot; never changes what readers see.

        It is sorted by key, so a lookup reads the row groups that can hold the key.
        Returns the batch that it reaches to.
        """
        last = max((p for p in self.positions() if through is None or p <= through), default=None)
        if last is None or last in self.snapshots():
            return last
        view = self.rebuild(last).repartitionByRange(self.key).sortWithinPartitions(self.key)
        (
            self._with_filter(view.write)
            .option("maxRecordsPerFile", rows_per_file)
            .mode("overwrite")
            .parquet(f"{self._snapshots.path}/{last[0]}.{last[1]}")
        )
        return last

    def drop_compacted(self) -> None:
        """Delete the batches and older snapshots that the newest snapshot stands for.

        Readers that started before it was written must have ended.
        """
        done = self.snapshots()
        for epoch, batch in self.positions():
            if done and (epoch, batch) <= done[-1]:
                self._batches.delete(f"epoch={epoch}/batch={batch}")
        for epoch, batch in done[:-1]:
            self._snapshots.delete(f"{epoch}.{batch}")


def _up_to(position: Position) -> Column:
    epoch, batch = position
    return (F.col("epoch") < epoch) | ((F.col("epoch") == epoch) & (F.col("batch") <= batch))
