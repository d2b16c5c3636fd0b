"""Business days: calendar days at the fixed offset +09:00."""

from pyspark.sql import Column, functions as F

# The business day's UTC offset and how a day is labelled in reports.
DAY_OFFSET_SECONDS = 9 * 3600
DAY_SUFFIX = "T00:00:00+09:00"
SECONDS_PER_DAY = 86_400


def business_day(instant: Column) -> Column:
    """The business day an instant falls on; integer arithmetic, so independent of session zone."""
    shifted = F.unix_seconds(instant) + F.lit(DAY_OFFSET_SECONDS)
    whole_days = (shifted - F.pmod(shifted, F.lit(SECONDS_PER_DAY))) / F.lit(SECONDS_PER_DAY)
    return F.date_from_unix_date(whole_days.cast("int"))


def business_day_of_millis(epoch_ms: Column) -> Column:
    """The same day for an instant given in epoch milliseconds."""
    return business_day(F.timestamp_millis(epoch_ms))


def day_label(day: Column) -> Column:
    """Report text of a business day: its midnight with the offset."""
    return F.concat(day.cast("string"), F.lit(DAY_SUFFIX))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from `start` to `end`, as a BIGINT."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def utc_text(instant: Column) -> Column:
    """`2026-06-29T13:30:45Z`, cut to the second."""
    return F.date_format(utc_clock(instant), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_clock(instant: Column) -> Column:
    """The instant as a UTC clock reads it, a timestamp without a zone: no session zone changes it."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
