"""Conversions between timestamps, epoch numbers and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.schemas import NO_TIME, TIME_FORMAT

# fixed values: the epoch seconds of the years 1 to 9999, beyond which text is ambiguous
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def time_text(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)


def parse_time(c: Column) -> Column:
    """Text to timestamp; text that is not a time gives NULL instead of an error."""
    return F.try_to_timestamp(c, F.lit(TIME_FORMAT))


def epoch_seconds_text(c: Column) -> Column:
    """Epoch seconds (as text or number) to time text; anything else gives a dash."""
    seconds = c.try_cast("bigint")
    known = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))
    return F.coalesce(time_text(known), F.lit(NO_TIME))


def epoch_millis_text(c: Column) -> Column:
    millis = c.try_cast("bigint")
    in_range = millis.between(FIRST_SECOND * 1000, LAST_SECOND * 1000)
    return time_text(F.when(in_range, F.timestamp_millis(millis)))


def either_time_text(c: Column) -> Column:
    """Accept a stored time as epoch milliseconds or as already formatted text."""
    return F.coalesce(epoch_millis_text(c), time_text(parse_time(c)))
