"""Column expressions for JSON text and lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Accept what a strict JSON reader accepts; a broken document is kept in CORRUPT.
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def is_envelope(value: Column) -> Column:
    """True when the first character above U+0020 is an opening brace; never null."""
    return F.coalesce(value.rlike(r"^[\x00-\x20]*\{"), F.lit(False))


def parse_json(value: Column, schema: T.StructType | str) -> Column:
    return F.from_json(value, schema, JSON_OPTIONS)


def with_parsed(df: DataFrame, value: Column, schema: T.StructType, name: str) -> DataFrame:
    """Add the parsed document as a struct column, parsing each text once.

    A plain column would be parsed again in every filter that uses it, since a filter is
    moved below the projection and takes a copy of the expression along. A filter is not
    moved below a generated column.
    """
    return df.select("*", F.explode(F.array(parse_json(value, schema))).alias(name))


def compact_json(value: Column) -> Column:
    """The document re-serialised without blanks, with all of its fields; null when the
    text is not one whole JSON object.

    A text leaf that meets an object takes it over as text. Standing as an element and as
    a field at once keeps out texts that only complete the frame around them.
    """
    frame = T.StructType([T.StructField("v", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    alone = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>", JSON_OPTIONS)
    field = parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")), frame).getField("v")
    return F.when(is_envelope(value) & (F.size(alone) == 1), field)


# Stands for a blank still to be written; JSON texts hold no control characters.
_GAP = "\x01"


def spaced_json(compact: Column) -> Column:
    """A compact document with a blank after each colon and comma outside of strings."""
    marked = F.regexp_replace(compact, r'("(?:\\.|[^"\\])*+")|([:,])', f"$1$2{_GAP}")
    return F.replace(F.replace(marked, F.lit(f'"{_GAP}'), F.lit('"')), F.lit(_GAP), F.lit(" "))


def on_one_line(value: Column) -> Column:
    """Line breaks as blanks; in a JSON document they can only stand between tokens."""
    return F.translate(value, "\r\n", "  ")


def text_at(paths: list[str]) -> T.StructType:
    """Schema with a text leaf at each dotted path."""
    fields: dict[str, list[str] | None] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        if rest:
            fields.setdefault(head, []).append(rest)
        else:
            fields[head] = None
    return T.StructType(
        [
            T.StructField(name, T.StringType() if inner is None else text_at(inner))
            for name, inner in fields.items()
        ]
    )


def loose_double(text: Column) -> Column:
    """Number in a JSON text leaf, null when it is not one."""
    return text.try_cast("double")


def loose_long(text: Column) -> Column:
    """Whole number in a JSON text leaf, with any fraction cut off."""
    return F.coalesce(text.try_cast("bigint"), loose_double(text).try_cast("bigint"))


def loose_int(text: Column) -> Column:
    return loose_long(text).try_cast("int")


def cut_to_int(number: Column) -> Column:
    """Cut a double to an int; values outside the int range become its nearest end."""
    inside = F.least(F.greatest(number, F.lit(-2147483648.0)), F.lit(2147483647.0))
    return F.when(number.isNotNull(), inside.try_cast("int"))
