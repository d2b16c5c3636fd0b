from datetime import date, datetime, timezone

import pytest

from slugline.plans import params as P

DAY = 86_400_000


def reason(call, *args):
    with pytest.raises(P.InvalidParameter) as caught:
        call(*args)
    assert caught.value.status_code == 400
    return caught.value.reason


def test_a_range_needs_both_ends():
    assert reason(P.TimeRange.of, 1, None) == P.BOTH_OR_NEITHER
    assert reason(P.TimeRange.of, None, 1) == P.BOTH_OR_NEITHER


def test_order_and_length_of_a_range():
    assert reason(P.TimeRange.of, 2, 1) == P.WRONG_ORDER
    assert P.TimeRange.of(5, 5).day_count == 1
    assert P.TimeRange.of(0, 3660 * DAY).day_count == 3661
    assert reason(P.TimeRange.of, 0, 3660 * DAY + 1) == P.TOO_LONG


@pytest.mark.parametrize("extreme", [2**63 - 1, -(2**63)])
def test_unrepresentable_instants(extreme):
    assert reason(P.TimeRange.of, min(0, extreme), max(0, extreme)) == P.NOT_AN_INSTANT


def test_default_range_is_a_year_up_to_now():
    now = int(datetime(2026, 6, 30, 3, tzinfo=timezone.utc).timestamp() * 1000)
    span = P.TimeRange.of(clock=lambda: now)
    assert (span.from_ms, span.to_ms) == (now - 365 * DAY, now)
    assert (span.last_day, span.day_count) == (date(2026, 6, 30), 366)


def test_days_turn_over_at_15_utc():
    before = int(datetime(2026, 6, 29, 14, 59, 59, tzinfo=timezone.utc).timestamp() * 1000)
    span = P.TimeRange.of(before, before + 1000)
    assert (span.first_day, span.last_day) == (date(2026, 6, 29), date(2026, 6, 30))


def test_days_before_1970():
    assert P.business_date(-1) == date(1970, 1, 1)
    assert P.business_date(-DAY) == date(1969, 12, 31)


def test_a_range_of_days_covers_them():
    span = P.TimeRange.of_days(date(2026, 6, 29), date(2026, 7, 1))
    assert (span.first_day, span.last_day, span.day_count) == (date(2026, 6, 29), date(2026, 7, 1), 3)


def test_units():
    assert P.DurationUnit.of() is P.DurationUnit.DAYS
    assert P.DurationUnit.of("hours").column == "avg_hours"
    assert reason(P.DurationUnit.of, "minutes") == P.BAD_UNIT
    assert reason(P.DurationUnit.of, "") == P.BAD_UNIT


def test_limits():
    assert [P.checked_limit(), P.checked_limit(1), P.checked_limit(1000)] == [20, 1, 1000]
    assert reason(P.checked_limit, 0) == reason(P.checked_limit, 1001) == P.BAD_LIMIT


def test_messages_name_the_parameter_class():
    assert str(P.InvalidParameter(P.BAD_UNIT)) == "invalid query parameter: unit must be days or hours"
