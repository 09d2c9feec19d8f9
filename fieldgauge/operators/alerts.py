"""Threshold alerts on a number inside a JSON message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import CORRUPT, is_envelope, loose_int, text_at, with_parsed
from ..schema import ALERT_INVALID_TEXT, ALERT_TEXT, ALERT_THRESHOLD


def over_threshold(
    df: DataFrame,
    json_col: str,
    path: str,
    threshold: int = ALERT_THRESHOLD,
    extra: dict[str, str] | None = None,
    name: str = "level",
) -> DataFrame:
    """Keep the rows whose number at `path` is above the threshold.

    The number is added as `name`; `extra` maps further column names to paths. A text
    that is not a JSON object, or has no number there, is dropped.
    """
    wanted = {name: path} | (extra or {})
    wire = text_at(list(wanted.values())).add(CORRUPT, "string")
    value = F.col(json_col)
    fields = {n: loose_int(F.col(f"_j.{p}")) for n, p in wanted.items()}
    return (
        with_parsed(df, F.when(is_envelope(value), value), wire, "_j")
        .withColumns(fields)
        .filter(F.col(name) > threshold)
        .drop("_j")
    )


def alert_text(level: Column, temperature: Column) -> Column:
    """Alert text of a row over the threshold."""
    return F.when(temperature.isNull(), F.lit(ALERT_INVALID_TEXT)).otherwise(
        F.format_string(ALERT_TEXT, level, temperature)
    )


def rain_alerts(
    df: DataFrame,
    value: str = "value",
    level: str = "weather.humidity",
    temperature: str = "weather.temperature",
    threshold: int = ALERT_THRESHOLD,
) -> DataFrame:
    """Replace the value of each message over the threshold by its alert; key unchanged."""
    names = df.columns
    hits = over_threshold(df, value, level, threshold, {"_t": temperature}, "_level")
    text = alert_text(F.col("_level"), F.col("_t"))
    return hits.select(*[text.alias(n) if n == value else F.col(n) for n in names])
