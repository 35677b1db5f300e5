from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from helpers import at, raw_frame, raw_row
from tallyhouse.operators import hours


def test_date_given_or_yesterday():
    assert hours.run_date("2026-03-20") == date(2026, 3, 20)
    now = datetime(2026, 3, 1, 0, 30, tzinfo=timezone.utc)
    assert hours.run_date(None, now) == date(2026, 2, 28)
    with pytest.raises(ValueError):
        hours.run_date("not-a-date")


def test_configured_window():
    assert hours.effective_window(configured=(2, 3)) == (2, 3)


def test_window_from_interval():
    run = ("2026-03-22T00:00:00Z", "2026-03-22T01:00:00Z")
    assert hours.effective_window(interval=run) == (0, 1)


def test_sources_rank_per_value():
    run = ("2026-03-22T04:00:00Z", "2026-03-22T09:00:00Z")
    assert hours.effective_window(1, None, (2, 3), run) == (1, 3)
    assert hours.effective_window(None, 2, (None, None), run) == (4, 2)
    assert hours.effective_window() == (0, 24)


@pytest.mark.parametrize("start, count", [(23, 2), (-1, 1), (24, 1), (0, 0), (0, 25)])
def test_window_outside_the_day(start, count):
    with pytest.raises(ValueError):
        hours.check_hour_window(start, count)


@pytest.mark.parametrize(
    "start, end, window",
    [
        ("2026-03-22T03:00:00Z", "2026-03-22T07:30:00Z", (3, 5)),
        ("2026-03-22T03:20:00Z", "2026-03-22T03:40:00Z", (3, 1)),
        ("2026-03-22T00:00:00Z", "2026-03-23T00:00:00Z", (0, 24)),
        ("2026-03-22", "2026-03-23", (0, 24)),
        ("2026-03-22T00:00:00Z", "2026-03-23T00:00:01Z", None),
        ("2026-03-22T00:00:00Z", "2026-03-24T00:00:00Z", None),
        ("2026-03-22T05:00:00Z", "2026-03-22T05:00:00Z", None),
        ("2026-03-22T05:00:00Z", "2026-03-22T04:00:00Z", None),
    ],
)
def test_interval_hours(start, end, window):
    assert hours.interval_hours(start, end) == window


moments = st.datetimes(datetime(2026, 3, 22), datetime(2026, 3, 24)).map(
    lambda d: d.replace(tzinfo=timezone.utc)
)


@given(moments, moments)
def test_interval_covers_exactly_the_touched_hours(start, end):
    window = hours.interval_hours(start, end)
    midnight = start.replace(hour=0, minute=0, second=0, microsecond=0)
    inside = start < end <= midnight + timedelta(days=1)
    assert (window is not None) == inside
    if window:
        touched = [
            h
            for h in range(24)
            if midnight + timedelta(hours=h) < end and midnight + timedelta(hours=h + 1) > start
        ]
        assert list(range(window[0], sum(window))) == touched


def test_hour_window_rows(spark):
    raw = raw_frame(spark, *[raw_row(str(h), f"2024-05-01T{h:02d}:59:59") for h in range(24)])
    kept = {r.id for r in hours.hour_window(raw, 5, 2).collect()}
    assert kept == {"5", "6"}


def test_interval_rows_take_the_whole_day_without_a_window(spark):
    raw = raw_frame(
        spark, raw_row("a", "2024-05-01T00:00:00"), raw_row("b", "2024-05-01T23:59:59"),
        raw_row("c", "2024-05-02T00:00:00"),
    )
    kept = hours.hour_window_for_interval(raw, at("2024-05-01T00:00:00"), at("2024-05-03T00:00:00"))
    assert {r.id for r in kept.collect()} == {"a", "b"}
