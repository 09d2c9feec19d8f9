"""Landed documents of an external JSON feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import FEED


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line, as text in `value`; parsed by `adapt_feed`."""
    return spark.read.text(path)


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType = FEED, multi_line: bool = False
) -> DataFrame:
    """Documents as nested columns; `multi_line` for one pretty-printed document per file."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def stream_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)
