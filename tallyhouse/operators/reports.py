"""Report queries over the raw, staging and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import event_date
from tallyhouse.operators.marts import dated
from tallyhouse.sources.landing import DateLike, as_date
from tallyhouse.sources.tables import raw_row_counts

#: Repository-days a ranking holds, and dates a load status holds (fixed values).
TOP_REPO_DAYS = 200
STATUS_DATES = 14


def date_range_filter(
    df: DataFrame, start: DateLike, end: DateLike, column: str = "event_date"
) -> DataFrame:
    """Rows dated ``start`` to ``end``, both included.

    On a stored table the column is the partition column, so other dates are
    never opened.
    """
    first, last = as_date(start), as_date(end)
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    return df.filter(F.col(column).between(F.lit(first), F.lit(last)))


def _mart_rows(mart: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    # Stored tables have their partition column last; reports show the date first.
    rows = date_range_filter(mart, start, end)
    return rows.select("event_date", *[c for c in rows.columns if c != "event_date"])


def date_bounds(raw: DataFrame, default: DateLike | None = None) -> DataFrame:
    """First and last date of the raw records; ``default`` (today) when there are none."""
    day = F.col("event_date") if "event_date" in raw.columns else event_date("created_at")
    fallback = F.current_date() if default is None else F.lit(as_date(default))
    return raw.agg(
        F.coalesce(F.min(day), fallback).alias("min_date"),
        F.coalesce(F.max(day), fallback).alias("max_date"),
    )


def type_range(by_type: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Type mart of a date range, busiest type of each date first."""
    return _mart_rows(by_type, start, end).orderBy(
        "event_date", F.desc("event_count"), "event_type"
    )


def hour_range(by_hour: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Hour mart of a date range in time order."""
    return _mart_rows(by_hour, start, end).orderBy("event_date", "hour_of_day")


def top_repo_days(
    repos: DataFrame, start: DateLike, end: DateLike, n: int = TOP_REPO_DAYS
) -> DataFrame:
    """The ``n`` busiest (date, repository) rows of a range."""
    ranked = _mart_rows(repos, start, end).orderBy(
        F.desc("total_events"), "event_date", "repo_name"
    )
    return ranked.limit(n)


def language_range(trends: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Push activity per date and known language in a range, most pushes first."""
    known = date_range_filter(trends, start, end).filter(F.col("repo_language").isNotNull())
    return (
        known.groupBy("event_date", "repo_language")
        .agg(F.sum("push_count").alias("push_count"), F.sum("contributors").alias("contributors"))
        .orderBy(F.desc("push_count"), "event_date", "repo_language")
    )


def kpi_totals(by_type: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Events and number of event types in a range; 0 when there are none."""
    return date_range_filter(by_type, start, end).agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events"),
        F.count_distinct("event_type").alias("event_types"),
    )


def kpi_uniques(stg: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Exact distinct actors and repositories over a range.

    Counted on staging rows because distinct counts of single days do not add up.
    """
    return date_range_filter(dated(stg), start, end).agg(
        F.count_distinct("actor_login").alias("unique_actors"),
        F.count_distinct("repo_name").alias("unique_repos"),
    )


def kpis(by_type: DataFrame, stg: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Totals and distinct counts as one row.

    The two one-row results are stacked and folded by ``max``, which skips the
    columns a side does not have.
    """
    parts = kpi_totals(by_type, start, end).unionByName(
        kpi_uniques(stg, start, end), allowMissingColumns=True
    )
    names = ("total_events", "event_types", "unique_actors", "unique_repos")
    return parts.agg(*[F.max(name).alias(name) for name in names])


def pipeline_status(raw: DataFrame, n: int = STATUS_DATES) -> DataFrame:
    """Raw rows of the latest ``n`` dates; records without a date sort last."""
    return raw_row_counts(raw).orderBy(F.desc_nulls_last("event_date")).limit(n)
