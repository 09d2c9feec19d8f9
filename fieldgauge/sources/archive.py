"""Partitioned Parquet archive of flat readings."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bits import interleave, scaled
from ..functions.times import month_text, utc_date
from ..schema import READING
from .storage import Folder

PARTITIONS = ("year", "month")


def with_partitions(df: DataFrame, seconds: str | Column = "status_timestamp") -> DataFrame:
    """Add UTC `year` and two-digit `month` of a column in epoch seconds."""
    date = utc_date(F.col(seconds) if isinstance(seconds, str) else seconds)
    return df.withColumns({"year": F.year(date), "month": month_text(date)})


def write_archive(
    df: DataFrame,
    path: str,
    station: str = "station_id",
    batch: str | None = None,
    rows_per_file: int | None = None,
    gather: bool = True,
) -> None:
    """Write rows that carry `year` and `month` into station / year / month folders.

    Rows are brought together per folder to get few files. The rebalance hint lets
    Spark cut a folder that outgrows the advisory partition size into several tasks, so
    one large station does not end up in one. With `batch` the folder gets one more
    level, and writing the same batch again replaces its files only.

    `gather=False` saves the shuffle where each input partition holds few stations
    anyway, as those of a keyed topic do.
    """
    folders = [station, *PARTITIONS]
    out = df.hint("rebalance", *folders) if gather else df
    if batch is not None:
        out = out.withColumn("batch", F.lit(batch))
        folders.append("batch")
    writer = out.write.partitionBy(*folders).option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if batch is None:
        writer.mode("append").parquet(path)
    else:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def archive_schema(data: T.StructType = READING, station: str = "station_id") -> T.StructType:
    """Columns of an archive read back: folder names would otherwise set their own types."""
    inner = [f for f in data.fields if f.name not in (station, *PARTITIONS)]
    outer = [
        data[station],
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
    return T.StructType(inner + outer)


def read_archive(
    spark: SparkSession, path: str, data: T.StructType = READING, station: str = "station_id"
) -> DataFrame:
    schema = archive_schema(data, station)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def compact_archive(
    spark: SparkSession,
    path: str,
    target: str,
    data: T.StructType = READING,
    station: str = "station_id",
    rows_per_file: int | None = None,
) -> None:
    """Write an archive again with the batch folders of each month merged to few files.

    `path` can be a whole archive or some `station=.../year=...` folders of it as a glob;
    `target` is a new folder, so that readers of the old one are not disturbed. Run it on
    months that are closed, then switch readers and delete the old folders.
    """
    schema = archive_schema(data, station)
    base = path.partition(f"/{station}=")[0]
    rows = spark.read.schema(schema).option("basePath", base).parquet(path).select(*schema.names)
    month = F.lpad(F.col("month").cast("string"), 2, "0")
    write_archive(rows.withColumn("month", month), target, station, rows_per_file=rows_per_file)


# ---- clustering inside a month

# Rows of a page, the least that a reader can skip.
PAGE_ROWS = 4_000


def write_clustered(
    df: DataFrame,
    path: str,
    station: str = "station_id",
    seconds: str = "status_timestamp",
    files: int | None = None,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write rows that carry `year` and `month` into year / month folders, clustered by
    station and second.

    Rows are ordered by a key whose bits are in turn those of the station and of the
    second, so a page holds few stations over a short time, and the statistics of pages
    let a reader skip by either column and most of all by both. Without a folder per
    station there can be any number of stations. Rows without station or second come first.
    """
    bounds = df.agg(F.min(station), F.max(station), F.min(seconds), F.max(seconds)).first()
    place = [
        F.coalesce(scaled(F.col(name), low, high), F.lit(0))
        for name, low, high in ((station, *bounds[:2]), (seconds, *bounds[2:]))
        if low is not None
    ]
    key = interleave(*place) if len(place) == 2 else F.lit(0)
    count = [files] if files is not None else []
    (
        df.withColumn("_cluster", key)
        .repartitionByRange(*count, "year", "month", "_cluster")
        .sortWithinPartitions("year", "month", "_cluster")
        .drop("_cluster")
        .write.partitionBy("year", "month")
        .option("parquet.page.row.count.limit", page_rows)
        .mode("append")
        .parquet(path)
    )


def read_clustered(spark: SparkSession, path: str, data: T.StructType = READING) -> DataFrame:
    inner = [f for f in data.fields if f.name not in PARTITIONS]
    outer = [T.StructField(name, T.IntegerType()) for name in PARTITIONS]
    return spark.read.schema(T.StructType(inner + outer)).parquet(path)


def read_span(
    clustered: DataFrame, stations: tuple[int, int], seconds: tuple[int, int],
    station_col: str = "station_id", seconds_col: str = "status_timestamp",
) -> DataFrame:
    """Rows of a range of stations and a range of seconds, both ends included.

    Folders are chosen by year and month, pages by their statistics.
    """
    first, last = (datetime.fromtimestamp(s, UTC) for s in seconds)
    months = F.col("year") * 12 + F.col("month")
    return clustered.where(
        F.col(station_col).between(*stations)
        & F.col(seconds_col).between(*seconds)
        & months.between(first.year * 12 + first.month, last.year * 12 + last.month)
    )


# ---- small files

FILE_BYTES = 128 * 1024**2
# Small files that are merged in one job.
FILES_AT_ONCE = 20_000


def small_files(spark: SparkSession, path: str, station: str = "station_id", file_bytes: int = FILE_BYTES) -> DataFrame:
    """(folder, files, bytes) of the station and month folders that hold several files of
    less than half the target size. Only names and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_extract("path", rf"^(.*/{station}=[^/]*/year=[^/]*/month=[^/]*)/", 1)
    return (
        files.where(F.col("length") < file_bytes // 2)
        .select(folder.alias("folder"), "path", "length")
        .groupBy("folder")
        .agg(F.collect_list("path").alias("files"), F.sum("length").alias("bytes"))
        .where(F.size("files") > 1)
    )


def merge_small_files(
    spark: SparkSession,
    path: str,
    data: T.StructType = READING,
    station: str = "station_id",
    file_bytes: int = FILE_BYTES,
) -> int:
    """Pack the small files of each folder into files of about the target size, below
    `batch=merged-...`, and delete them; all other files stay as they are, name and
    content. Returns how many went.

    Run it on months that are closed and without readers: between the writing and the
    deleting rows are there twice. A run that dies in between has both: delete the folders of
    its batch name, as the files it was made of are all still there, and run it again.
    """
    schema, gone = archive_schema(data, station), 0
    files: list[str] = []
    total = 0

    def merge() -> None:
        name = f"merged-{uuid.uuid4().hex}"
        rows = spark.read.schema(schema).option("basePath", path).parquet(*files).select(*schema.names)
        month = F.lpad(F.col("month").cast("string"), 2, "0")
        folders = [station, *PARTITIONS]
        parts = max(1, -(-total // file_bytes))
        # Rows of a folder stay together; a folder that outgrows a task is cut by the hint.
        (
            rows.withColumn("month", month)
            .withColumn("batch", F.lit(name))
            .hint("rebalance", parts, *folders)
            .write.partitionBy(*folders, "batch")
            .option("compression", "snappy")
            .mode("append")
            .parquet(path)
        )
        for file in files:
            folder, _, last = file.rpartition("/")
            Folder(spark, folder).delete(last)

    for row in small_files(spark, path, station, file_bytes).toLocalIterator():
        files += row.files
        total += row.bytes
        if len(files) >= FILES_AT_ONCE:
            merge()
            gone, files, total = gone + len(files), [], 0
    if files:
        merge()
    return gone + len(files)


def read_slice(archive: DataFrame, **folder: object) -> DataFrame:
    """Rows of the given station, year and month; no other folder is scanned."""
    for name, value in folder.items():
        archive = archive.filter(F.col(name) == F.lit(value))
    return archive


def read_folder(
    spark: SparkSession,
    path: str,
    station: object,
    year: int,
    month: int,
    data: T.StructType = READING,
    station_col: str = "station_id",
) -> DataFrame:
    """`read_slice` for one folder, without listing the rest of a large archive first."""
    schema = archive_schema(data, station_col)
    folder = f"{station_col}={station}/year={year}/month={month:02d}"
    if not Folder(spark, path).exists(folder):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(f"{path}/{folder}").select(*schema.names)
