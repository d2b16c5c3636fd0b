"""Report parameters, checked on the driver before any plan is built."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from enum import Enum

from slugline.functions.days import DAY_OFFSET_SECONDS, SECONDS_PER_DAY

MS_PER_DAY = SECONDS_PER_DAY * 1000

# Limits, defaults and messages of the parameter checks.
MAX_SPAN_DAYS = 3660
DEFAULT_SPAN_DAYS = 365
DEFAULT_LIMIT = 20
MAX_LIMIT = 1000
BOTH_OR_NEITHER = "from and to must both be provided"
NOT_AN_INSTANT = "from and to must be valid Unix epoch milliseconds"
WRONG_ORDER = "from must be less than or equal to to"
TOO_LONG = f"time range must not exceed {MAX_SPAN_DAYS} days"
BAD_UNIT = "unit must be days or hours"
BAD_LIMIT = f"limit must be between 1 and {MAX_LIMIT}"


class InvalidParameter(ValueError):
    """A report was asked for with a parameter it does not accept."""

    status_code = 400

    def __init__(self, reason: str):
        super().__init__(f"invalid query parameter: {reason}")
        self.reason = reason


def now_ms() -> int:
    return int(datetime.now(timezone.utc).timestamp() * 1000)


def business_date(epoch_ms: int) -> date:
    """The business day of an instant, as driver-side arithmetic so that it becomes a literal."""
    return date(1970, 1, 1) + timedelta(days=(epoch_ms + DAY_OFFSET_SECONDS * 1000) // MS_PER_DAY)


@dataclass(frozen=True)
class TimeRange:
    """A range of instants, read as the business days it touches, both ends included."""

    from_ms: int
    to_ms: int

    def __post_init__(self):
        try:
            business_date(self.from_ms), business_date(self.to_ms)
        except OverflowError:
            raise InvalidParameter(NOT_AN_INSTANT) from None
        if self.from_ms > self.to_ms:
            raise InvalidParameter(WRONG_ORDER)
        if self.to_ms - self.from_ms > MAX_SPAN_DAYS * MS_PER_DAY:
            raise InvalidParameter(TOO_LONG)

    @classmethod
    def of(
        cls, from_ms: int | None = None, to_ms: int | None = None, clock: Callable[[], int] = now_ms
    ) -> TimeRange:
        if from_ms is None and to_ms is None:
            end = clock()
            return cls(end - DEFAULT_SPAN_DAYS * MS_PER_DAY, end)
        if from_ms is None or to_ms is None:
            raise InvalidParameter(BOTH_OR_NEITHER)
        return cls(from_ms, to_ms)

    @classmethod
    def of_days(cls, first: date, last: date) -> TimeRange:
        """From the first instant of `first` to the last millisecond of `last`."""

        def midnight_ms(day: date) -> int:
            return (day - date(1970, 1, 1)).days * MS_PER_DAY - DAY_OFFSET_SECONDS * 1000

        return cls.of(midnight_ms(first), midnight_ms(last) + MS_PER_DAY - 1)

    @property
    def first_day(self) -> date:
        return business_date(self.from_ms)

    @property
    def last_day(self) -> date:
        return business_date(self.to_ms)

    @property
    def day_count(self) -> int:
        return (self.last_day - self.first_day).days + 1


class DurationUnit(Enum):
    """Unit a lead time is averaged in: seconds per unit, and the column that carries it."""

    DAYS = ("days", 86_400.0)
    HOURS = ("hours", 3_600.0)

    def __init__(self, label: str, seconds: float):
        self.label = label
        self.seconds = seconds

    @property
    def column(self) -> str:
        return f"avg_{self.label}"

    @classmethod
    def of(cls, name: str | None = None) -> DurationUnit:
        if name is None:
            return cls.DAYS
        for unit in cls:
            if unit.label == name:
                return unit
        raise InvalidParameter(BAD_UNIT)


def checked_limit(limit: int | None = None) -> int:
    limit = DEFAULT_LIMIT if limit is None else limit
    if not 1 <= limit <= MAX_LIMIT:
        raise InvalidParameter(BAD_LIMIT)
    return limit
