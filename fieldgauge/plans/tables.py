"""The driver's tables in the role of telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_seconds
from ..operators.messages import build_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Stations in the reading side of the data; the archive has folders for each, so their
# number must not grow with the rows. Message keys are the users, of which there are many.
STATIONS = 10


def as_readings(events: DataFrame) -> DataFrame:
    """Events as flat readings, next to the columns of the event."""
    return events.withColumns(
        {
            "station_id": F.col("user_id") % STATIONS + 1,
            "s_no": F.col("event_id"),
            "battery_status": F.col("event_type"),
            "status_timestamp": epoch_seconds(F.col("ts")),
            "humidity": F.get_json_object("props", "$.k").cast("int"),
            "temperature": F.floor("value").cast("int"),
            "wind_speed": (F.col("event_id") % 251).cast("int"),
        }
    )


def damaged(text: Column, number: Column) -> Column:
    """A message text with each kind of fault and of odd value in some of the rows."""
    return (
        F.when(number % 11 == 0, F.lit(None))
        .when(number % 7 == 0, F.concat(F.lit("x"), text))
        .when(number % 13 == 0, F.expr("left(_text, length(_text) - 3)"))
        .when(number % 17 == 0, F.replace(text, F.lit('"weather"'), F.lit('"other"')))
        .when(number % 19 == 0, F.replace(text, F.lit('"humidity":'), F.lit('"humidity":"n/a","h":')))
        .when(number % 23 == 0, F.replace(text, F.lit('"temperature"'), F.lit('"t"')))
        .when(number % 31 == 0, F.regexp_replace(text, r'"humidity":(\d+)', '"humidity":"$1"'))
        .when(number % 37 == 0, F.regexp_replace(text, r'"humidity":(\d+)', '"humidity":$1.7'))
        .when(number % 41 == 0, F.regexp_replace(text, r'"humidity":\d+', '"humidity":true'))
        .when(number % 43 == 0, F.regexp_replace(text, r'"humidity":\d+', '"humidity":null'))
        .when(number % 47 == 0, F.concat(text, F.lit(" x")))
        .when(number % 53 == 0, F.replace(text, F.lit('"temperature":'), F.lit('"temperature":1,"temperature":')))
        .when(number % 59 == 0, F.replace(text, F.lit('{"station_id"'), F.lit('{"firmware":"1: a, \\"b\\"","station_id"')))
        .when(number % 5 == 0, F.concat(F.lit("\t\n "), text))
        .when(number % 3 == 0, F.replace(text, F.lit(',"'), F.lit(', "')))
        .otherwise(text)
    )


def as_messages(events: DataFrame) -> DataFrame:
    """Events as raw topic messages; some lack the key, some are damaged."""
    number = F.col("event_id")
    return build_envelope(as_readings(events), "_text").select(
        F.when(number % 29 != 0, F.col("user_id").cast("string")).alias("key"),
        damaged(F.col("_text"), number).alias("value"),
        F.lit(0).alias("partition"),
        number.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def over_partitions(messages: DataFrame, partitions: int = 4) -> DataFrame:
    """The same messages dealt over several partitions, each with offsets of its own."""
    number = F.col("offset")
    return messages.withColumns(
        {
            "partition": F.pmod(number, F.lit(partitions)).cast("int"),
            "offset": F.floor(number / partitions).cast("bigint"),
        }
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))
