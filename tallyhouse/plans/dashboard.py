"""All figures of the dashboard for a date range, from the stored tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators import analytics, reports, uniques
from tallyhouse.plans.daily import MEMBER_DAYS, RAW, STAGING
from tallyhouse.sources.landing import DateLike


def available_range(spark: SparkSession, database: str, default: DateLike | None = None):
    """First and last loaded date, the range a dashboard opens with."""
    return tuple(reports.date_bounds(spark.table(f"{database}.{RAW}"), default).first())


@contextmanager
def dashboard(
    spark: SparkSession,
    database: str,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> Iterator[dict[str, DataFrame]]:
    """Results by name, valid inside the ``with`` block.

    Four small inputs feed most figures and are kept while the block runs: the
    type, hour and language rows of the range (a few per date) and the 200
    busiest repository-days.  Each is read from its mart once.  Distinct actors and
    repositories come from the bitmaps by date, so staging is read only where these
    were never built.
    """
    if start is None or end is None:
        first, last = available_range(spark, database)
        start, end = start or first, end or last

    def table(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}")

    types = reports.type_range(table("events_by_type"), start, end).persist()
    hours = reports.hour_range(table("events_by_hour"), start, end).persist()
    days = reports.top_repo_days(table("top_repos"), start, end).persist()
    languages = reports.language_range(table("language_trends"), start, end).persist()
    rollup = analytics.repo_rollup(days)
    if spark.catalog.tableExists(f"{database}.{MEMBER_DAYS}"):
        kpis = uniques.range_kpis(table("events_by_type"), table(MEMBER_DAYS), start, end)
    else:
        kpis = reports.kpis(table("events_by_type"), table(STAGING), start, end)
    try:
        yield {
            "kpis": kpis,
            "pipeline_status": reports.pipeline_status(table(RAW)),
            # overview
            "events_by_type": types,
            "events_by_hour": hours,
            "daily_totals": analytics.daily_totals(types),
            "avg_daily": analytics.avg_daily(types),
            "peak_day": analytics.peak_day(types),
            "variability": analytics.variability(types),
            "type_totals": analytics.type_totals(types),
            "dominant_type": analytics.dominant_type(types),
            "type_mix": analytics.type_mix(types),
            "hour_heatmap": analytics.hour_heatmap(hours),
            "hour_pattern": analytics.hour_pattern(hours),
            # repositories
            "top_repo_days": days,
            "repo_rollup": rollup,
            "most_active_repo": analytics.most_active_repo(rollup),
            "top_share": analytics.top_share(rollup),
            "median_repo_events": analytics.median_repo_events(rollup),
            "top_repo_chart": analytics.top_repo_chart(rollup),
            "repo_table": analytics.repo_table(rollup),
            "repo_breakdown": analytics.repo_breakdown(rollup),
            "repo_treemap": analytics.repo_treemap(rollup),
            # languages
            "language_range": languages,
            "language_totals": analytics.language_totals(languages),
            "dominant_language": analytics.dominant_language(languages),
            "tracked_languages": analytics.tracked_languages(languages),
        }
    finally:
        for kept in (types, hours, days, languages):
            kept.unpersist()
