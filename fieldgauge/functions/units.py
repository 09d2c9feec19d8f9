"""Durations and sizes written with units, as in profiler reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds per unit, and bytes per unit: fixed values.
DURATION_MS = {
    "d": 86_400_000.0,
    "h": 3_600_000.0,
    "m": 60_000.0,
    "s": 1_000.0,
    "ms": 1.0,
    "us": 0.001,
    "ns": 0.000001,
}
SIZE_BYTES = {
    "bytes": 1.0,
    "kB": 1024.0,
    "MB": 1024.0**2,
    "GB": 1024.0**3,
    "TB": 1024.0**4,
}


# A character that no report holds, to cut the parts of a match apart.
_CUT = "\x01"


def _amount(text: Column, name: str, factors: dict[str, float]) -> Column:
    units = "|".join(factors)
    part = rf"([0-9]+(?:\.[0-9]+)?)\s*({units})\b"
    # One search per line: the text is replaced by the parts of its first match.
    pattern = rf"(?ms)\A.*?(?:^|\s){name}\s*=\s*{part}(?:\s+{part})?.*\z"
    found = F.split(F.regexp_replace(text, pattern, rf"{_CUT}$1{_CUT}$2{_CUT}$3{_CUT}$4"), _CUT)
    factor = F.create_map(*[F.lit(x) for pair in factors.items() for x in pair])

    def amount(at: int) -> Column:
        return F.get(found, F.lit(at)).try_cast("double") * F.element_at(factor, F.get(found, F.lit(at + 1)))

    # Without a match there is no cut at the beginning.
    return F.when(F.startswith(text, F.lit(_CUT)), None).when(
        F.get(found, F.lit(0)) == "", amount(1) + F.coalesce(amount(3), F.lit(0.0))
    )


def duration_ms(text: Column, name: str = "duration") -> Column:
    """Milliseconds in a `name = <number> <unit>` line, null without one.

    A long duration is written in two parts, such as `1 m 5 s`.
    """
    return _amount(text, name, DURATION_MS)


def size_bytes(text: Column, name: str = "weight") -> Column:
    """Whole bytes in a `name = <number> <unit>` line, null without one."""
    return F.round(_amount(text, name, SIZE_BYTES)).cast("bigint")


def field_text(text: Column, name: str) -> Column:
    """Right-hand side of the first `name = text` line, null without one."""
    found = F.regexp_extract(text, rf"(?m)(?:^|\s){name}\s*=\s*(.*)$", 1)
    return F.when(found != "", F.trim(found))
