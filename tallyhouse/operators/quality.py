"""Declarative data-quality checks.

A check is an aggregate that counts failures, so all checks of a table are
evaluated in one pass over it.  NULL passes every column rule but ``not_null``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import hour_of_day
from tallyhouse.operators.marts import dated


@dataclass(frozen=True)
class Check:
    """One rule of a table; ``failures`` is SQL for an aggregate that must be 0.

    The rest says how the rule is worked out from one date at a time: ``partial`` is the
    aggregate of a date (``failures`` where it is left out), ``members`` a column whose
    distinct values of the date are kept, and ``decide`` the failures in terms of ``total``,
    the sum over the dates, and ``seen``, the distinct values of all of them.
    """

    column: str | None
    name: str
    failures: str
    partial: str | None = None
    members: str | None = None
    decide: str = "total"


def not_null(column: str) -> Check:
    """No missing values."""
    return Check(column, "not_null", f"count_if({column} IS NULL)")


def unique(column: str) -> Check:
    """No value twice."""
    counted = f"count({column})"
    return Check(column, "unique", f"{counted} - count(DISTINCT {column})", partial=counted)


def non_negative(column: str) -> Check:
    """No value below 0."""
    return Check(column, "non_negative", f"count_if({column} < 0)")


def positive(column: str) -> Check:
    """No value of 0 or less."""
    return Check(column, "positive", f"count_if({column} <= 0)")


def at_most(column: str, limit: float) -> Check:
    """No value above ``limit``."""
    return Check(column, "max", f"count_if({column} > {limit})")


def no_rows(name: str, condition: str) -> Check:
    """Table rule: no row meets the SQL ``condition``."""
    return Check(None, name, f"count_if({condition})")


def holds(name: str, condition: str, **by_date: str) -> Check:
    """Table rule: the SQL aggregate ``condition`` is true."""
    return Check(None, name, f"IF({condition}, 0, 1)", **by_date)


# Limits, rule names and the checks of each table.

MIN_EVENT_TYPES = 5
LAST_HOUR = 23

IDENTITY_FIELDS = no_rows(
    "core identity fields are present",
    "event_id IS NULL OR actor_login IS NULL OR event_type IS NULL",
)
ENOUGH_EVENT_TYPES = holds(
    "multiple event types exist",
    f"count(DISTINCT event_type) >= {MIN_EVENT_TYPES}",
    partial="count(*)",
    members="event_type",
    decide=f"IF(size(seen) >= {MIN_EVENT_TYPES}, 0, 1)",
)
HOUR_DOMAIN = no_rows("hours in valid range", f"hour_of_day NOT BETWEEN 0 AND {LAST_HOUR}")
REPO_PRESENT = no_rows("no null repo names", "repo_name IS NULL")
LANGUAGE_ROWS = holds(
    "language trend rows exist", "count(*) > 0", partial="count(*)", decide="IF(total > 0, 0, 1)"
)

TABLE_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_events": (
        not_null("event_id"),
        unique("event_id"),
        not_null("event_timestamp"),
        not_null("event_type"),
        not_null("actor_login"),
        not_null("actor_id"),
        IDENTITY_FIELDS,
    ),
    "events_by_type": (
        not_null("event_date"),
        not_null("event_type"),
        positive("event_count"),
        non_negative("unique_actors"),
        non_negative("unique_repos"),
        ENOUGH_EVENT_TYPES,
    ),
    "events_by_hour": (
        not_null("event_date"),
        not_null("hour_of_day"),
        non_negative("hour_of_day"),
        at_most("hour_of_day", LAST_HOUR),
        positive("event_count"),
        HOUR_DOMAIN,
    ),
    "top_repos": (
        not_null("event_date"),
        not_null("repo_name"),
        positive("total_events"),
        non_negative("unique_contributors"),
        REPO_PRESENT,
    ),
    "language_trends": (
        not_null("event_date"),
        not_null("repo_name"),
        positive("push_count"),
        positive("contributors"),
        LANGUAGE_ROWS,
    ),
}


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "\\'") + "'"


def run_checks(df: DataFrame, table: str, checks: Iterable[Check]) -> DataFrame:
    """One row per check from a single aggregate over ``df``."""
    rules = list(checks)
    measured = df.agg(
        *[F.expr(f"CAST({rule.failures} AS BIGINT)").alias(f"f{i}") for i, rule in enumerate(rules)]
    )
    entries = [
        f"struct({_text(table)} AS table_name, {_text(rule.column)} AS column_name, "
        f"{_text(rule.name)} AS check_name, f{i} AS failures, f{i} = 0 AS passed)"
        for i, rule in enumerate(rules)
    ]
    return measured.selectExpr(f"inline(array({', '.join(entries)}))")


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All declared checks of the given tables, one row per check."""
    reports = [run_checks(df, name, TABLE_CHECKS[name]) for name, df in tables.items()]
    combined, *others = reports
    for report in others:
        combined = combined.unionByName(report)
    return combined


def check_sql(spark: SparkSession, query: str, expected: object, name: str = "sql") -> DataFrame:
    """Compare the single value a SQL query returns with ``expected``."""
    value = spark.sql(query).toDF("value")
    return value.select(
        F.lit(name).alias("check_name"),
        F.col("value").cast("string").alias("value"),
        F.col("value").eqNullSafe(F.lit(expected)).alias("passed"),
    )


class QualityError(RuntimeError):
    """Checks failed; tables that depend on the checked ones must not be built."""

    def __init__(self, failed: list):
        lines = [
            f"{r.table_name}.{r.column_name or '*'} {r.check_name}: {r.failures} failures"
            for r in failed
        ]
        super().__init__("; ".join(lines))
        self.failed = failed


def failed_checks(report: DataFrame) -> DataFrame:
    """Rows of a report that block what comes after."""
    return report.filter(~F.col("passed"))


def gate(report: DataFrame) -> None:
    """Raise QualityError when a report holds a failed check.

    The report has one row per declared check, so collecting it is bounded.
    """
    failed = failed_checks(report).collect()
    if failed:
        raise QualityError(failed)


def hour_completeness(stg: DataFrame, by_hour: DataFrame) -> DataFrame:
    """Hours seen per date in staging and in the hour mart, out of 24."""
    absent = F.lit(None).cast("int")
    staged = dated(stg).select(
        "event_date", hour_of_day("event_timestamp").alias("staged"), absent.alias("mart")
    )
    kept = by_hour.select("event_date", absent.alias("staged"), F.col("hour_of_day").alias("mart"))
    full = F.lit(LAST_HOUR + 1)
    return (
        staged.distinct()
        .unionByName(kept)
        .groupBy("event_date")
        .agg(
            F.count_distinct("staged").alias("staging_hours"),
            F.count_distinct("mart").alias("mart_hours"),
        )
        .withColumn(
            "complete", (F.col("staging_hours") == full) & (F.col("mart_hours") == full)
        )
    )
