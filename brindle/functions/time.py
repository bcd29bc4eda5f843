"""Timestamps given as ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column) -> Column:
    """ISO text as a UTC TIMESTAMP: 'Z' and '+02:00' are honoured, text without an offset is UTC whatever the
    session's zone, anything unreadable (and null or empty text) is null."""
    trimmed = F.trim(text)
    # the usual spellings are told by single characters; patterns are left to the rest
    usual = trimmed.endswith("Z") | (F.substring(trimmed, -6, 1).isin("+", "-") & (F.substring(trimmed, -3, 1) == ":") & (F.length(trimmed) > 16))
    zoned = trimmed.rlike(r"(?:[zZ]|[T ]\d.*[+-]\d{2}(?::?\d{2})?)$")
    spelled = F.regexp_replace(trimmed, r"([T ]\d.*[+-]\d{2})(\d{2})$", "$1:$2")
    day = F.concat(trimmed, F.lit("T00:00:00Z"))
    return F.when(usual, trimmed).when(zoned, spelled).when(F.length(trimmed) == 10, day).otherwise(F.concat(trimmed, F.lit("Z"))).try_cast("timestamp")


def parse_micros(text: Column) -> Column:
    """Microseconds since 1970 UTC of ISO text, null where unreadable."""
    return F.unix_micros(parse_instant(text))
