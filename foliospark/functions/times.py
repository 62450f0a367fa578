"""Times: microseconds since 1970 and readings of several notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp (with or without zone) in a UTC session."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def read_time(c: Column | str) -> Column:
    """A UTC timestamp from ISO notations; no zone means UTC; null where missing or unreadable."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    full = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t)
    zoned = F.when(full.rlike(r"(?i)(z|utc|gmt|[+-]\d{2}:?\d{0,2})$") & ~full.rlike(r"^\d{4}-\d{2}-\d{2}$"), full).otherwise(F.concat(F.when(full.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(full, F.lit("T00:00:00"))).otherwise(full), F.lit("Z")))
    return zoned.try_cast("timestamp")
