"""Token ids as Parquet files that can be read in part.

Layout of a folder:

    tokens/   one row per document, in ascending order of id over the files:
              doc_id, part, part_start (ids before it in its file), n_tokens, ids
    parts/    one row per file: part, start (ids in the files before), n_docs, n_tokens

`ids` is a list column with dictionary or delta encoding. Row groups and pages are small
and pages carry an index, so that a filter on doc_id or part_start reads few pages, and
a question about numbers alone never touches `ids`.

Null and empty texts consist of the end id. Rows with equal ids stay, ordered by a hash
of their text. A null id comes first.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import bound_batches, text_array, text_slices
from .tokens import SLICE_BYTES, encoder, with_end

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
ENCODINGS = ("dictionary", "delta")


def encode_rows(vocab: str):
    """Rows of one sorted partition to rows of the file; the start runs along."""

    def run(batches):
        known, part, at = encoder(vocab), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = text_array(batch.column(1))
            for begin, some in text_slices(texts, SLICE_BYTES):
                ids, bounds = with_end(*known.encode(some))
                count = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, len(some)),
                        pa.array(np.full(len(some), part), pa.int32()),
                        pa.array(at + bounds[:-1], pa.int64()),
                        pa.array(count, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype("<i4"))),
                    ],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                at += int(bounds[-1])
        known.forget()

    return run


def write_tokens(
    df: DataFrame,
    path: str,
    vocab: str,
    doc_id: str = "doc_id",
    text: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode all rows and write them in order of id; other columns are not written.

    The texts are sorted by one range shuffle; each task encodes and writes its range.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    spark = df.sparkSession
    bound_batches(spark)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    encoded = (
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode_rows(vocab), SCHEMA)
    )
    (
        encoded.write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "v2" if encoding == "delta" else "v1")
        .option("compression", "zstd")
        .parquet(f"{path}/tokens")
    )
    per_part = (
        spark.read.schema(SCHEMA)
        .parquet(f"{path}/tokens")
        .groupBy("part")
        .agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    )
    # One row per file, so one task can add them up.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per_part.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids. Select less and filter by doc_id to read less."""
    parts = spark.read.schema("part int, n_docs long, n_tokens long, start long").parquet(f"{path}/parts")
    return (
        spark.read.schema(SCHEMA)
        .parquet(f"{path}/tokens")
        .join(parts.select("part", F.col("start").alias("file_start")), "part")
        .select("doc_id", (F.col("file_start") + F.col("part_start")).alias("start"), "n_tokens", "ids")
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and n_tokens; the ids are not read."""
    return read_tokens(spark, path).drop("ids")


def read_span(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """Documents that hold ids of the span, with the ids that lie in it.

    The table of files tells which of them the span lies in, and the numbers alone of the
    first of these which document it begins in. With both known as plain numbers the reader
    skips all other files, row groups and pages.
    """
    stop = start + length
    parts = spark.read.schema("part int, n_docs long, n_tokens long, start long").parquet(f"{path}/parts")
    within = parts.where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    # Two rows at most.
    ends = within.agg(F.min_by(F.struct("part", "start"), "part"), F.max_by(F.struct("part", "start"), "part")).first()
    tokens = spark.read.schema(SCHEMA).parquet(f"{path}/tokens")
    if ends[0] is None or length <= 0:
        rows = tokens.limit(0).withColumn("start", F.lit(0).cast("long"))
    else:
        (first, first_start), (last, last_start) = ends
        at = F.col("part_start")
        before = tokens.where((F.col("part") == first) & (at <= max(start - first_start, 0)))
        least = before.agg(F.max("part_start")).first()[0] or 0
        rows = tokens.where(
            F.col("part").between(first, last)
            & ((F.col("part") > first) | (at >= least))
            & ((F.col("part") < last) | (at < stop - last_start))
        )
        known = within.select("part", F.col("start").alias("file_start"))
        rows = rows.join(known, "part").withColumn("start", F.col("file_start") + at)
    inside = rows.where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    begin = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    end = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens"))
    return inside.select(
        "doc_id", "start", "n_tokens", F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids")
    )


@F.arrow_udf(T.LongType())
def _ids_crc32(ids: pa.Array) -> pa.Array:
    bounds = ids.offsets.to_numpy()
    raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
    found = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.array(found, pa.int64())


def ids_crc32(ids: str | Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return _ids_crc32(ids)
