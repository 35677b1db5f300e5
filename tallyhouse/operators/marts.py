"""Daily aggregates of the staging table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import event_date, hour_of_day, infer_language, split_repo, type_filter
from tallyhouse.operators.grouping import count_where
from tallyhouse.schemas import ACTIVITY_COUNTERS, PUSH_ACTIVITY_TYPES


def dated(stg: DataFrame) -> DataFrame:
    """Staging rows with ``event_date``.

    The stored table has it as its partition column, which lets date filters
    skip files; otherwise it is computed from the timestamp.
    """
    if "event_date" in stg.columns:
        return stg
    return stg.withColumn("event_date", event_date("event_timestamp"))


def require_repo(df: DataFrame, column: str = "repo_name") -> DataFrame:
    """Rows that name a repository."""
    return df.filter(F.col(column).isNotNull())


def events_by_type(stg: DataFrame) -> DataFrame:
    """Events, distinct actors and distinct repositories per date and type."""
    return (
        dated(stg)
        .groupBy("event_date", "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("actor_login").alias("unique_actors"),
            F.count_distinct("repo_name").alias("unique_repos"),
        )
    )


def events_by_hour(stg: DataFrame) -> DataFrame:
    """Events and distinct actors per date and hour of day."""
    return (
        dated(stg)
        .groupBy("event_date", hour_of_day("event_timestamp").alias("hour_of_day"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("actor_login").alias("unique_actors"),
        )
    )


def top_repos(stg: DataFrame, counters: Mapping[str, str] = ACTIVITY_COUNTERS) -> DataFrame:
    """Activity counters per date and repository; ranking is left to the reader."""
    return (
        require_repo(dated(stg))
        .groupBy("event_date", "repo_name")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            *[count_where("event_type", t).alias(name) for name, t in counters.items()],
            F.count_distinct("actor_login").alias("unique_contributors"),
        )
    )


def repo_push_activity(
    stg: DataFrame, types: Sequence[str] = PUSH_ACTIVITY_TYPES
) -> DataFrame:
    """Push activity and contributors per date and repository.

    Events without a repository form a group of their own.  Owner and short name
    follow from the full name, so they are derived once per group afterwards and
    stay out of the grouping key.
    """
    per_repo = (
        dated(stg)
        .filter(type_filter("event_type", types))
        .groupBy("event_date", "repo_name")
        .agg(
            F.count(F.lit(1)).alias("push_count"),
            F.count_distinct("actor_login").alias("contributors"),
        )
    )
    return per_repo.select(
        "event_date",
        split_repo("repo_name", 0).alias("repo_owner"),
        split_repo("repo_name", 1).alias("repo_short_name"),
        "repo_name",
        "push_count",
        "contributors",
    )


def language_trends(stg: DataFrame) -> DataFrame:
    """Push activity with the language guessed from the repository's short name."""
    return repo_push_activity(stg).select(
        "event_date",
        "repo_owner",
        "repo_short_name",
        "repo_name",
        infer_language("repo_short_name").alias("repo_language"),
        "push_count",
        "contributors",
    )


#: Mart table name -> builder from staging rows.
MARTS = {
    "events_by_type": events_by_type,
    "events_by_hour": events_by_hour,
    "top_repos": top_repos,
    "language_trends": language_trends,
}
