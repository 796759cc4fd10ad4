"""Time text and event-time columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_text(instant: Column | str, zoned: bool = True) -> Column:
    """Time as text to the second. An instant is rendered in UTC whatever the
    session zone is; a zone-free time (``zoned=False``) is rendered as it reads.

    Neither goes through a time of the session zone: one that falls into the hour a
    clock change skips would come out an hour off.
    """
    instant = F.col(instant) if isinstance(instant, str) else instant
    if zoned:
        instant = wall_clock(instant)
    return F.substring(instant.cast("string"), 1, 19)


def event_time(text: Column | str, kind: str = "timestamp") -> Column:
    """Time written in a record; null when the text is no time.

    ``kind="timestamp_ntz"`` for zone-free batch work. Watermarks need the
    default kind.
    """
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast(kind)


def wall_time(moment: datetime) -> Column:
    """A zone-free time as a literal, the same in every session zone."""
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def wall_clock(instant: Column) -> Column:
    """What a clock in UTC shows at an instant, without a zone, whatever the session's is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
