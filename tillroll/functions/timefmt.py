"""ISO-8601 text <-> timestamps.

Documents carry instants as text such as ``2025-09-01T10:30:00Z`` or
``2025-09-01T10:30:00.123456Z``. A trailing ``Z`` means UTC; the session
zone is pinned to UTC, so parsed values and printed values agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text layouts written and read here.
ISO_UTC_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_UTC_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 text -> ``timestamp`` (instant). Malformed text raises under
    ANSI mode rather than turning into NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def parse_iso_wall(c: Column | str) -> Column:
    """ISO-8601 UTC text -> ``timestamp_ntz`` holding the UTC wall clock."""
    return parse_iso(c).cast("timestamp_ntz")


def format_iso(c: Column | str, micros: bool = True) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, ISO_UTC_MICROS if micros else ISO_UTC_SECONDS)
