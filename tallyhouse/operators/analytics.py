"""Figures and chart data computed from the report queries.

Inputs are results of :mod:`tallyhouse.operators.reports`.  Everything is an
aggregate or a bounded top-k; shares are computed in one aggregate or against a
scalar subquery, never with a window over the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import last_path_part, short_repo_label

# Sizes of the charts and tables, and the table's headings.
MIX_TYPES = 6
SHARE_REPOS = 10
CHART_REPOS = 20
TABLE_REPOS = 30
BREAKDOWN_REPOS = 10
TREEMAP_REPOS = 40
REPO_MEASURES = (
    "total_events",
    "stars",
    "forks",
    "pushes",
    "pull_requests",
    "issues",
    "unique_contributors",
)
BREAKDOWN_MEASURES = ("pushes", "stars", "forks", "pull_requests", "issues")
TABLE_HEADINGS = (
    "Repository",
    "Events",
    "⭐ Stars",
    "🍴 Forks",
    "📤 Pushes",
    "🔀 PRs",
    "🐛 Issues",
    "👥 Contributors",
)


def _at_least_one(value: Column) -> Column:
    return F.greatest(value, F.lit(1))


# -- events by type ----------------------------------------------------------


def daily_totals(by_type: DataFrame) -> DataFrame:
    """Events per date in date order."""
    return (
        by_type.groupBy("event_date")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("event_date")
    )


def _mean_daily() -> Column:
    return F.avg("event_count").cast("long")


def avg_daily(by_type: DataFrame) -> DataFrame:
    """Mean events per date, cut to a whole number."""
    return daily_totals(by_type).agg(_mean_daily().alias("avg_daily"))


def peak_day(by_type: DataFrame) -> DataFrame:
    """The date with most events; the earliest of several."""
    return daily_totals(by_type).orderBy(F.desc("event_count"), "event_date").limit(1)


def variability(by_type: DataFrame) -> DataFrame:
    """Sample deviation of the daily events relative to their mean.

    NULL for a single day.
    """
    spread = F.stddev_samp("event_count") / _at_least_one(_mean_daily())
    return daily_totals(by_type).agg(spread.alias("variability"))


def type_totals(by_type: DataFrame) -> DataFrame:
    """Events per type, busiest first."""
    return (
        by_type.groupBy("event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def _leader(totals: DataFrame, name: str, amount: str) -> DataFrame:
    # One aggregate: the first name among those with the largest amount, and
    # that amount's share of the whole.  No rows give no row.
    first = F.min_by(name, F.struct(-F.col(amount), F.col(name)))
    share = F.max(amount) / _at_least_one(F.sum(amount))
    return totals.agg(first.alias(name), share.alias("share")).filter(F.col("share").isNotNull())


def dominant_type(by_type: DataFrame) -> DataFrame:
    """The busiest type and its share of all events."""
    return _leader(type_totals(by_type), "event_type", "event_count")


def type_mix(by_type: DataFrame, n: int = MIX_TYPES) -> DataFrame:
    """Daily rows of the ``n`` busiest types; dates as text labels."""
    leaders = type_totals(by_type).limit(n).select("event_type")
    return by_type.join(leaders, "event_type", "left_semi").select(
        F.col("event_date").cast("string").alias("event_date"),
        "event_type",
        "event_count",
        "unique_actors",
        "unique_repos",
    )


# -- events by hour ----------------------------------------------------------


def hour_heatmap(by_hour: DataFrame) -> DataFrame:
    """Dates (as text) by hours of day, 0 where nothing happened.

    The 24 columns are fixed, so no pass over the data is needed to find them.
    """
    hours = list(range(24))
    names = [f"hour_{h:02d}" for h in hours]
    return (
        by_hour.groupBy(F.col("event_date").cast("string").alias("event_date"))
        .pivot("hour_of_day", hours)
        .agg(F.avg("event_count"))
        .na.fill(0.0)
        .toDF("event_date", *names)
        .orderBy("event_date")
    )


def hour_pattern(by_hour: DataFrame) -> DataFrame:
    """Events per hour of day over all dates."""
    return (
        by_hour.groupBy("hour_of_day")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("hour_of_day")
    )


# -- repositories ------------------------------------------------------------


def _ranked(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy(F.desc("total_events"), "repo_name")


def _labelled(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("repo_short", short_repo_label("repo_name"))


def repo_rollup(repo_days: DataFrame) -> DataFrame:
    """Ranked repository-days summed per repository.

    Contributors of different days are added up, so one person may count more
    than once.
    """
    sums = [F.sum(name).alias(name) for name in REPO_MEASURES]
    return _ranked(repo_days.groupBy("repo_name").agg(*sums))


def most_active_repo(rollup: DataFrame) -> DataFrame:
    """The busiest repository with its label."""
    top = _labelled(_ranked(rollup)).limit(1)
    return top.select("repo_name", "repo_short", "total_events")


def top_share(rollup: DataFrame, n: int = SHARE_REPOS) -> DataFrame:
    """Share of all events that the ``n`` busiest repositories hold."""
    leading = _ranked(rollup).limit(n).agg(F.sum("total_events")).scalar()
    return rollup.agg((leading / _at_least_one(F.sum("total_events"))).alias("share"))


def median_repo_events(rollup: DataFrame) -> DataFrame:
    """Exact median of events per repository, cut to a whole number."""
    return rollup.agg(F.median("total_events").cast("long").alias("median_events"))


def top_repo_chart(rollup: DataFrame, n: int = CHART_REPOS) -> DataFrame:
    """The ``n`` busiest repositories with labels, smallest first for a bar chart."""
    top = _labelled(_ranked(rollup).limit(n))
    return top.orderBy("total_events", F.desc("repo_name"))


def repo_table(
    rollup: DataFrame, n: int = TABLE_REPOS, headings: Sequence[str] = TABLE_HEADINGS
) -> DataFrame:
    """The ``n`` busiest repositories under display headings."""
    return _ranked(rollup).limit(n).select("repo_name", *REPO_MEASURES).toDF(*headings)


def repo_breakdown(rollup: DataFrame, n: int = BREAKDOWN_REPOS) -> DataFrame:
    """Activity kinds of the ``n`` busiest repositories, one row per kind."""
    top = _labelled(_ranked(rollup).limit(n))
    return top.unpivot(
        ["repo_name", "repo_short"], list(BREAKDOWN_MEASURES), "measure", "event_count"
    )


def repo_treemap(rollup: DataFrame, n: int = TREEMAP_REPOS) -> DataFrame:
    """Boxes of the ``n`` busiest repositories, one per last path part.

    Repositories that share a label share a box: events, pushes and stars add up,
    contributors are averaged with the events as weight.
    """
    top = _ranked(rollup).limit(n).withColumn("label", last_path_part("repo_name"))
    weighted = F.sum(F.col("unique_contributors") * F.col("total_events"))
    return top.groupBy("label").agg(
        F.sum("total_events").alias("total_events"),
        (weighted / F.sum("total_events")).alias("contributors"),
        F.sum("pushes").alias("pushes"),
        F.sum("stars").alias("stars"),
    )


# -- languages ---------------------------------------------------------------


def language_totals(languages: DataFrame) -> DataFrame:
    """Push activity per language, most pushes first."""
    return (
        languages.groupBy("repo_language")
        .agg(F.sum("push_count").alias("push_count"), F.sum("contributors").alias("contributors"))
        .orderBy(F.desc("push_count"), "repo_language")
    )


def dominant_language(languages: DataFrame) -> DataFrame:
    """The language with most pushes and its share of those with a known language."""
    return _leader(language_totals(languages), "repo_language", "push_count")


def tracked_languages(languages: DataFrame) -> DataFrame:
    """Number of languages seen."""
    return languages.agg(F.count_distinct("repo_language").alias("languages"))
