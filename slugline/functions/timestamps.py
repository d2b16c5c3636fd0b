"""RFC 3339 text to TIMESTAMP."""

from pyspark.sql import Column, functions as F

# The accepted form, whose offset is mandatory and below 24 hours, and the subset
# of it that Spark's own cast reads the same way.
RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?"
    r"([Zz]|[+\-−]([01]\d|2[0-3]):[0-5]\d)\z"
)
PLAIN_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:[0-5]\d(\.\d+)?Z\z"
_DATE_CHARS, _CLOCK_START, _CLOCK_CHARS, _SECOND_START, _OFFSET_CHARS = 10, 12, 8, 18, 6


def rfc3339_timestamp(text: Column) -> Column:
    """The instant, cut to microseconds; NULL where the text is not a full RFC 3339 date-time."""
    return F.when(text.rlike(PLAIN_UTC), text.try_cast("timestamp")).when(text.rlike(RFC3339), _any_form(text))


def _any_form(text: Column) -> Column:
    """The instant of a text that passed the gate, put together from its parts.

    Spark's own cast stops at offsets of 18 hours and knows no second 60, so the clock is read
    as UTC and the offset subtracted. A second of 60 counts as the first one of the next minute.
    """
    zulu = F.lower(F.right(text, F.lit(1))) == "z"
    leap = F.substring(text, _SECOND_START, 2) == "60"
    clock = F.when(leap, F.concat(F.substring(text, _CLOCK_START, _CLOCK_CHARS - 2), F.lit("59"))).otherwise(
        F.substring(text, _CLOCK_START, _CLOCK_CHARS)
    )
    after_clock = F.substr(text, F.lit(_CLOCK_START + _CLOCK_CHARS))
    fraction = F.left(after_clock, F.length(after_clock) - F.when(zulu, 1).otherwise(_OFFSET_CHARS))
    local = F.concat(F.substring(text, 1, _DATE_CHARS), F.lit("T"), clock, fraction, F.lit("Z"))

    offset = F.right(text, F.lit(_OFFSET_CHARS))
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
    ahead = F.when(zulu, 0).when(F.left(offset, F.lit(1)) == "+", minutes).otherwise(-minutes)
    shift = F.when(leap, 1).otherwise(0) - ahead * 60
    return local.try_cast("timestamp") + F.make_dt_interval(secs=shift.cast("decimal(18,6)"))
