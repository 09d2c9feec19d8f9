"""Messages: envelope test, parsing with a reason for each rejected row, building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import (
    CORRUPT,
    compact_json,
    cut_to_int,
    is_envelope,
    loose_double,
    loose_int,
    loose_long,
    spaced_json,
    text_at,
    with_parsed,
)
from ..functions.times import in_calendar
from ..schema import DEFAULT_KEY, FEED, FEED_BATTERY, NESTED, NESTED_FIELDS, READING
from .ordering import number_rows

NOT_ENVELOPE = "not an envelope"
UNPARSABLE = "unparsable"
NO_DOCUMENT = "no document"
BAD_FIELDS = "missing or invalid: "

# Where each field of a reading sits in the wire form.
WIRE_PATHS = {
    field.name: f"{NESTED}.{field.name}" if field.name in NESTED_FIELDS else field.name
    for field in READING.fields
}
_COERCE = {"bigint": loose_long, "int": loose_int, "string": lambda text: text}


def with_default_key(df: DataFrame, key: str = "key", default: str = DEFAULT_KEY) -> DataFrame:
    return df.withColumn(key, F.coalesce(F.col(key), F.lit(default)))


def with_validity(df: DataFrame, value: str = "value", name: str = "valid") -> DataFrame:
    """First level of checking: is the value an envelope at all."""
    return df.withColumn(name, is_envelope(F.col(value)))


def classify(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the fields of a reading, and `reason`: null for a good row.

    Columns of the same names are replaced. The text is parsed once. Every row is kept,
    so that a caller can send rejected rows to a dead letter table and good ones to the
    archive.
    """
    wire = text_at(list(WIRE_PATHS.values())).add(CORRUPT, "string")
    parsed = with_parsed(df, F.col(value), wire, "_j").withColumns(
        {
            f.name: _COERCE[f.dataType.simpleString()](F.col(f"_j.{WIRE_PATHS[f.name]}"))
            for f in READING.fields
        }
    )
    return parsed.withColumn("reason", _reason(F.col(value))).drop("_j")


def _reason(value: Column) -> Column:
    def usable(name: str) -> Column:
        present = F.col(name).isNotNull()
        if name == "status_timestamp":
            return present & in_calendar(F.col(name))
        return present

    bad = [F.when(~usable(name), F.lit(path)) for name, path in WIRE_PATHS.items()]
    all_usable = usable(READING.names[0])
    for name in READING.names[1:]:
        all_usable = all_usable & usable(name)
    return (
        F.when(~is_envelope(value), F.lit(NOT_ENVELOPE))
        .when(F.col(f"_j.{CORRUPT}").isNotNull(), F.lit(UNPARSABLE))
        .when(~all_usable, F.concat(F.lit(BAD_FIELDS), F.concat_ws(", ", *bad)))
    )


def readings(classified: DataFrame) -> DataFrame:
    """The good rows of `classify`, as flat readings."""
    return classified.filter(F.col("reason").isNull()).select(*READING.names)


def dead_letters(classified: DataFrame, *keep: str) -> DataFrame:
    """The rejected rows of `classify`, text unchanged, with the reason."""
    return classified.filter(F.col("reason").isNotNull()).select(*keep, "reason")


def envelope(columns: dict[str, Column] | None = None) -> Column:
    """Wire form of a reading; `columns` replaces fields by other expressions."""
    pick = {name: F.col(name) for name in READING.names} | (columns or {})
    flat = [pick[n].alias(n) for n in READING.names if n not in NESTED_FIELDS]
    nested = F.struct(*[pick[n].alias(n) for n in NESTED_FIELDS]).alias(NESTED)
    return F.struct(*flat, nested)


def build_envelope(df: DataFrame, name: str = "value", **columns: Column) -> DataFrame:
    return df.withColumn(name, F.to_json(envelope(columns)))


def to_messages(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows for a keyed topic: the station as text key, the envelope as value."""
    station = columns.get("station_id", F.col("station_id"))
    return build_envelope(df, "value", **columns).select(
        station.cast("string").alias("key"), "value"
    )


def normalise_json(df: DataFrame, value: str = "value", spaced: bool = False) -> DataFrame:
    """Rewrite every JSON object with all its fields on one line, compact or spaced.

    Fields keep their order and repeats; numbers are written in their shortest form. Text
    that is not a JSON object is passed through unchanged.
    """
    compact = compact_json(F.col(value))
    return df.withColumn(value, F.coalesce(spaced_json(compact) if spaced else compact, F.col(value)))


def adapt_feed(
    df: DataFrame,
    document: str,
    station_id: Column,
    seconds: Column,
    sequence: Column,
    keep: list[str] | None = None,
) -> DataFrame:
    """Turn documents of an external feed into readings; works on tables and streams.

    `document` holds the JSON text. In a readable document a number that is absent counts
    as 0. `reason` is null for these; a row whose document is null or cannot be read has
    the reason and no numbers. `sequence` is the number of the document within its feed,
    for instance its offset in a topic.
    """
    wire = T.StructType([*FEED.fields, T.StructField(CORRUPT, T.StringType())])
    reason = F.when(F.col("_j").isNull() | F.col("_text").isNull(), F.lit(NO_DOCUMENT)).when(
        F.col(f"_j.{CORRUPT}").isNotNull(), F.lit(UNPARSABLE)
    )

    def current(name: str) -> Column:
        number = F.coalesce(loose_double(F.col(f"_j.current.{name}")), F.lit(0.0))
        return F.when(reason.isNull(), number)

    parsed = with_parsed(df.withColumn("_text", F.col(document)), F.col("_text"), wire, "_j")
    return parsed.select(
        *(keep or []),
        station_id.alias("station_id"),
        sequence.cast("bigint").alias("s_no"),
        F.lit(FEED_BATTERY).alias("battery_status"),
        seconds.alias("status_timestamp"),
        cut_to_int(current("relative_humidity_2m")).alias("humidity"),
        cut_to_int(current("temperature_2m")).alias("temperature"),
        cut_to_int(current("wind_speed_10m")).alias("wind_speed"),
        reason.alias("reason"),
    )


def adapt_ordered_feed(
    df: DataFrame,
    document: str,
    station_id: Column,
    seconds: Column,
    feed: list[str],
    order_by: list[str],
    block: Column | None = None,
) -> DataFrame:
    """The readings of `adapt_feed` for a table, with `s_no` counted from 1 in each feed.

    Documents that cannot be read are left out and not counted, as nothing is sent for
    them. `order_by` must be total; `block` cuts it into pieces, see `number_rows`.
    """
    keep = list(dict.fromkeys([*feed, *order_by]))
    parsed = adapt_feed(df, document, station_id, seconds, F.lit(0), keep).filter("reason is null")
    return number_rows(parsed.drop("s_no", "reason"), feed, order_by, "s_no", block).select(*keep, *READING.names)
