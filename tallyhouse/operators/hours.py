"""Hour windows of a day."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import hour_of_day

HOUR = timedelta(hours=1)


def run_date(text: str | None = None, now: datetime | None = None) -> date:
    """The requested ``YYYY-MM-DD`` date, else yesterday in UTC."""
    if text:
        return datetime.strptime(text, "%Y-%m-%d").date()
    current = now or datetime.now(timezone.utc)
    return (current - timedelta(days=1)).date()


def check_hour_window(start: int, count: int) -> tuple[int, int]:
    """The window itself when it lies inside one day, else ValueError."""
    if not 0 <= start <= 23:
        raise ValueError(f"start hour {start} is not in 0..23")
    if not 1 <= count <= 24:
        raise ValueError(f"hour count {count} is not in 1..24")
    if start + count > 24:
        raise ValueError(f"hours {start}..{start + count - 1} run past the end of the day")
    return start, count


def _utc(moment: datetime | str) -> datetime:
    parsed = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    if parsed.tzinfo is None:
        return parsed.replace(tzinfo=timezone.utc)
    return parsed.astimezone(timezone.utc)


def interval_hours(start: datetime | str, end: datetime | str) -> tuple[int, int] | None:
    """Hour window ``(start, count)`` that covers a run interval within one day.

    The last hour counts when it is only partly covered.  None when the interval
    is empty, leaves the day or is not readable; midnight at its end still belongs to
    the day.
    """
    try:
        first, last = _utc(start), _utc(end)
    except ValueError:
        return None
    midnight = datetime.combine(first.date(), time(), timezone.utc)
    stop = ceil((last - midnight) / HOUR)
    if last <= first or stop > 24:
        return None
    return first.hour, stop - first.hour


def effective_window(
    start: int | None = None,
    count: int | None = None,
    configured: tuple[int | None, int | None] = (None, None),
    interval: tuple[datetime | str, datetime | str] | None = None,
) -> tuple[int, int]:
    """Start and count, each from the first source that has it.

    Sources in order: the argument, the configured value, the run interval, the
    whole day.
    """
    derived = (interval and interval_hours(*interval)) or (0, 24)
    given = zip((start, count), configured, derived)
    first, length = (next(v for v in options if v is not None) for options in given)
    return check_hour_window(first, length)


def hour_window(
    df: DataFrame, start: int = 0, count: int = 24, timestamp: str = "created_at"
) -> DataFrame:
    """Rows of the hours ``[start, start + count)`` of any day."""
    first, length = check_hour_window(start, count)
    return df.filter(hour_of_day(timestamp).between(first, first + length - 1))


def hour_window_for_interval(
    df: DataFrame,
    start: datetime | str,
    end: datetime | str,
    timestamp: str = "created_at",
    default_day: date | None = None,
) -> DataFrame:
    """Rows of the run interval's date in the interval's hours.

    An interval that gives no window takes the whole date; one whose start is not
    readable takes the whole of ``default_day`` (yesterday in UTC).  Written as a
    range of instants, which scans can push down; a stored date column is tested
    too, so other partitions are skipped.
    """
    first, length = effective_window(interval=(start, end))
    try:
        day = _utc(start).date()
    except ValueError:
        day = default_day or run_date()
    opens = datetime.combine(day, time(), timezone.utc) + first * HOUR
    moment = F.col(timestamp)
    rows = df.filter((moment >= F.lit(opens)) & (moment < F.lit(opens + length * HOUR)))
    return rows.filter(F.col("event_date") == F.lit(day)) if "event_date" in df.columns else rows
