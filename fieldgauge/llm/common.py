"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

# Text that a Python worker takes at once. The record bound is Spark's own default.
BATCH_BYTES = 8 << 20
# Bytes that separate words: ASCII but letters and digits.
_BLANK = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound what is handed to a Python worker by bytes, so that long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder and read them again, cutting the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts; null ids are in no part."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one array of plain strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that hands free memory back, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except AttributeError:
        return lambda _: 0


def release_memory() -> None:
    """Return what is free to the system: workers live on through jobs of other kinds."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def text_slices(texts: pa.Array, size: int = BATCH_BYTES // 2) -> Iterator[tuple[int, pa.Array]]:
    """Cut an array of texts into runs of about `size` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop
    release_memory()


def plain_words(texts: pa.Array) -> pa.ListArray:
    """Lower-case words without ASCII punctuation; a text without any has one empty word."""
    raw = [t.lower().encode().translate(_BLANK).strip() for t in texts.to_pylist()]
    return pc.ascii_split_whitespace(pa.array(raw, pa.large_binary()).cast(pa.large_string()))


def isotonic(scores: list[float], hits: list[float], counts: list[float]) -> list[tuple[float, float]]:
    """Points (score, share of hits) of the rising step function nearest to the data.

    Neighbouring groups whose shares fall are pooled. A point stands at the mean score of
    its group; between points one interpolates.
    """
    pools: list[list[float]] = []
    for score, hit, count in sorted(zip(scores, hits, counts)):
        pools.append([score * count, hit, count])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [(score / count, hit / count) for score, hit, count in pools]
