"""Exports of the latest view and of archive rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import compact_json, on_one_line
from ..schema import LOG_ROWS_PER_FILE, SNAPSHOT_HEADER
from .storage import Folder


# The header is a file of its own, hidden from Spark and first in the order of names.
HEADER_FILE = "_header"


def snapshot_lines(view: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """`key,value` text lines; the value is not quoted, it ends at the end of the line.

    Line breaks in a value become blanks, which means the same in a JSON document. A key
    must not hold commas or line breaks.
    """
    line = F.concat_ws(",", F.col(key).cast("string"), on_one_line(F.col(value)))
    return view.select(line.alias("value"))


def write_snapshot(view: DataFrame, path: str, key: str = "key", value: str = "value") -> None:
    """Lines in part files: all files in order of name, put one after the other, are the
    export as one file with its header."""
    snapshot_lines(view, key, value).write.text(path)
    Folder(view.sparkSession, path).create_text(HEADER_FILE, f"{SNAPSHOT_HEADER}\n")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Read a snapshot export; only the first comma of a line separates."""
    parts = F.split("value", ",", 2)
    return spark.read.text(path).select(F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("value"))


_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(
    view: DataFrame, path: str, key: str = "key", value: str = "value", rows_per_file: int = LOG_ROWS_PER_FILE
) -> None:
    """Properly quoted variant of the snapshot, with a header in every file.

    A quoted value can hold line breaks, so a file is read by one task; that is why the
    rows of a file are bounded.
    """
    rows = view.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))
    rows.write.option("maxRecordsPerFile", rows_per_file).csv(path, **_CSV)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="key string, value string", multiLine=True, **_CSV)


def snapshot_json(view: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """One JSON object per key: `{"key": ..., "value": ...}`.

    A value that is a JSON object stands there as an object, other text as a string.
    """
    text = F.regexp_extract(F.to_json(F.array(F.col(value))), r"(?s)^\[(.*)\]$", 1)
    document = F.coalesce(compact_json(F.col(value)), F.when(F.col(value).isNotNull(), text), F.lit("null"))
    name = F.regexp_extract(F.to_json(F.array(F.col(key).cast("string"))), r"(?s)^\[(.*)\]$", 1)
    return view.select(F.concat(F.lit('{"key":'), name, F.lit(',"value":'), document, F.lit("}")).alias("value"))


# Of the document: the first file in the order of names, and the last.
FOOTER_FILE = "~footer"
# Names of part files have five digits, and beyond that they no longer sort by number.
MOST_FILES = 99_999


def _json_text(text: Column) -> Column:
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def write_json_document(view: DataFrame, path: str, key: str = "key", value: str = "value", files: int | None = None) -> None:
    """The whole view as one JSON object `{"key": value, ...}`, in part files written in
    parallel: all files in order of name, put one after the other, are the document.

    Members are sorted by key. Each stands on a line of its own and begins with the comma
    that separates it from the one before, whatever part file that is in; only the least
    key has none. A value that is a JSON object stands there as an object, other text as a
    string, null as null. A null key is the text `null`. The keys must differ.
    """
    if files is not None and files > MOST_FILES:
        raise ValueError(f"at most {MOST_FILES} files stay in the order of their names")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = view.select(name.alias("_key"), F.col(value).alias("_value"))
    # One row; nothing else of the view comes to the driver.
    least = rows.agg(F.min("_key")).first()[0]
    document = F.coalesce(compact_json(F.col("_value")), F.when(F.col("_value").isNotNull(), _json_text(F.col("_value"))), F.lit("null"))
    comma = F.when(F.col("_key") == F.lit(least), F.lit("")).otherwise(F.lit(","))
    order = [files] if files is not None else []
    (
        rows.repartitionByRange(*order, "_key")
        .sortWithinPartitions("_key")
        .select(F.concat(comma, _json_text(F.col("_key")), F.lit(":"), document).alias("value"))
        .write.text(path)
    )
    folder = Folder(view.sparkSession, path)
    folder.create_text(HEADER_FILE, "{\n")
    folder.create_text(FOOTER_FILE, "}\n")


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """key, value of such a document, read in parallel; objects as compact JSON text."""
    line = F.concat(F.lit("{"), F.regexp_replace("value", "^,", ""), F.lit("}"))
    members = F.from_json(line, T.MapType(T.StringType(), T.StringType()))
    lines = spark.read.option("pathGlobFilter", "part-*").text(path)
    return lines.select(F.explode(members).alias("key", "value"))


def write_documents(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON documents, the form bulk loaders of search indexes take."""
    df.write.json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
