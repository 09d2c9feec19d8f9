"""Epoch seconds and UTC calendar parts, independent of the session time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-01 and of the last second of 9999.
FIRST_SECOND = -62_135_596_800
LAST_SECOND = 253_402_300_799


def utc_date(seconds: Column) -> Column:
    days = (seconds - F.pmod(seconds, F.lit(86_400))) / 86_400
    return F.date_add(F.lit(datetime.date(1970, 1, 1)), days.try_cast("int"))


def in_calendar(seconds: Column) -> Column:
    return seconds.between(FIRST_SECOND, LAST_SECOND)


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp without time zone that holds UTC."""
    day = F.unix_date(ts.cast("date")).cast("bigint") * 86_400
    return day + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def month_text(date: Column) -> Column:
    """Month with two digits, as used in archive folders."""
    return F.lpad(F.month(date).cast("string"), 2, "0")
