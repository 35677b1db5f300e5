"""Registered queries: one per operator, over all of the driver's events."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.fixture import raw_events
from acceptance.warehouse import (
    as_lines,
    fresh_database,
    day_bounds,
    landed_files,
    mixed_files,
    stored_raw,
    warehouse,
)
from tallyhouse.functions import (
    event_date,
    hour_of_day,
    infer_language,
    json_texts,
    short_repo_label,
    split_repo,
    type_filter,
)
from tallyhouse.operators import (
    analytics,
    checkstates,
    grouping,
    hours,
    marts,
    quality,
    reports,
    staging,
    uniques,
)
from tallyhouse.plans import daily
from tallyhouse.schemas import ACTIVITY_COUNTERS, CLUSTERING, PUSH_ACTIVITY_TYPES
from tallyhouse.session import scratch_path
from tallyhouse.sources import landing, ndjson, publish, tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the operators that take some; the SQL twins use the same.
WEEK = ("2024-01-05", "2024-01-11")
WINDOW = (5, 2)
INTERVAL = ("2024-01-05T03:00:00Z", "2024-01-05T07:30:00Z")
TARGET_DAY = "2024-01-10"
STRAY_DAY = "2024-01-11"
KEEP_DAYS = 20
LABEL_LENGTH = 12
MIX_TYPES = 4
HOUR_LIMIT = 20


class Derived:
    """The relations queries start from, as lazy plans over the driver's table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stage_events(self.raw, payload=False)

    @cached_property
    def by_type(self) -> DataFrame:
        return marts.events_by_type(self.stg)

    @cached_property
    def by_hour(self) -> DataFrame:
        return marts.events_by_hour(self.stg)

    @cached_property
    def repos(self) -> DataFrame:
        return marts.top_repos(self.stg)

    @cached_property
    def trends(self) -> DataFrame:
        return marts.language_trends(self.stg)

    @cached_property
    def languages(self) -> DataFrame:
        return reports.language_range(self.trends, self.first_day, self.last_day)

    @cached_property
    def rollup(self) -> DataFrame:
        return analytics.repo_rollup(reports.top_repo_days(self.repos, self.first_day, self.last_day))

    @cached_property
    def first_day(self) -> str:
        return day_bounds(self.spark, self.sf_dir)[0]

    @cached_property
    def last_day(self) -> str:
        return day_bounds(self.spark, self.sf_dir)[1]

    @property
    def landed(self) -> landing.Landing:
        return landed_files(self.spark, self.sf_dir, "gzip")

    @property
    def all_days(self) -> list:
        return landing.days(self.first_day, self.last_day)


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, the type the SQL side has."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Fractions to 9 digits, so summation order does not show."""
    return df.withColumns({name: F.round(name, 9) for name in columns})


# -- sources, sinks, load semantics ------------------------------------------


def scan_plain(d: Derived) -> DataFrame:
    files = landed_files(d.spark, d.sf_dir, "none")
    return ndjson.scan_ndjson(d.spark, files.day_glob(d.all_days))


def hour_paths(d: Derived) -> DataFrame:
    layout = landing.Landing("raw")
    day, hour = F.col("event_date"), F.col("hour_of_day")
    return landing.landed_hours(d.spark, d.landed, d.all_days).select(
        day,
        hour,
        layout.hour_path_of(day, hour).alias("hour_path"),
        layout.daily_path_of(day).alias("daily_path"),
    )


def bad_record_budget(d: Derived) -> DataFrame:
    """Records without an id of one hour are cut short on landing, which makes them malformed."""
    path = scratch_path(d.spark, "malformed")
    lines = as_lines(d.raw)
    broken = (
        F.col("value").startswith('{"id":null')
        & (F.col("day") == F.lit(TARGET_DAY).cast("date"))
        & (F.col("hour") == F.lit("05"))
    )
    cut = F.expr("left(value, length(value) - 9)")
    lines.select(F.when(broken, cut).otherwise(F.col("value")).alias("value")).write.text(path)
    scan = ndjson.scan_ndjson(d.spark, path, keep_corrupt=True)
    return ndjson.bad_record_budget(scan)


def combine_hours(d: Derived) -> DataFrame:
    combined = ndjson.combine_hours(d.spark, d.landed, d.all_days)
    return combined.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("records"), F.count("id").alias("ids")
    )


def missing_hours(d: Derived) -> DataFrame:
    landed = d.raw.select(
        event_date("created_at").alias("event_date"), hour_of_day("created_at").alias("hour_of_day")
    )
    return landing.missing_hours(landed, d.first_day, d.last_day)


def missing_files(d: Derived) -> DataFrame:
    landed = landing.landed_hours(d.spark, d.landed, d.all_days)
    return landing.missing_hours(landed, d.first_day, d.last_day)


def ensure_table(d: Derived) -> DataFrame:
    database = stored_raw(d.spark, d.sf_dir, "ensured")
    tables.ensure_table(d.spark, f"{database}.raw_events")
    return tables.raw_row_counts(d.spark.table(f"{database}.raw_events"))


def delete_date(d: Derived) -> DataFrame:
    table = f"{stored_raw(d.spark, d.sf_dir, 'deleted')}.raw_events"
    tables.delete_date(d.spark, table, TARGET_DAY)
    return d.spark.table(table)


def replace_date(d: Derived) -> DataFrame:
    """Public records of the target day replace it twice; a stray day comes along."""
    table = f"{stored_raw(d.spark, d.sf_dir, 'replaced')}.raw_events"
    batch = d.raw.filter(
        F.col("public") & event_date("created_at").between(F.lit(TARGET_DAY), F.lit(STRAY_DAY))
    )
    for _ in range(2):
        tables.replace_date(batch, table, TARGET_DAY)
    return d.spark.table(table)


def replace_date_resumed(d: Derived) -> DataFrame:
    """A load of the target day that stops before it is adopted, and one that never got so far."""
    table = f"{stored_raw(d.spark, d.sf_dir, 'resumed')}.raw_events"
    day = d.all_days[0].fromisoformat(TARGET_DAY)
    dated = d.raw.withColumn("event_date", event_date("created_at"))
    rows = dated.filter(F.col("public") & (F.col("event_date") == F.lit(day)))
    load = publish.Load.begin(d.spark, table)
    load.write(rows.select(*d.spark.table(table).columns))
    load.commit([day])
    publish.recover(d.spark, table)
    lost = publish.Load.begin(d.spark, table)
    lost.write(dated.select(*d.spark.table(table).columns))
    publish.recover(d.spark, table)
    return d.spark.table(table)


def materialize(d: Derived) -> DataFrame:
    database = fresh_database(d.spark, "materialized")
    return tables.materialize(
        marts.top_repos(d.stg), f"{database}.top_repos", cluster_by=CLUSTERING["top_repos"]
    )


def backfill(d: Derived) -> DataFrame:
    database = fresh_database(d.spark, "backfilled")
    daily.load_dates(d.spark, database, d.landed, d.all_days, bad_record_limit=0)
    return d.spark.table(f"{database}.raw_events")


def backfill_mixed_names(d: Derived) -> DataFrame:
    """A range load of dates whose files are partly named by hours and partly not."""
    database = fresh_database(d.spark, "mixed")
    files = mixed_files(d.spark, d.sf_dir)
    daily.load_dates(d.spark, database, files, d.all_days, bad_record_limit=0)
    return d.spark.table(f"{database}.raw_events")


def load_changed(d: Derived) -> DataFrame:
    """A load of the first week, then of whatever the ledger does not know, then of nothing."""
    database = fresh_database(d.spark, "ledgered")
    week = [day for day in d.all_days if str(day) <= WEEK[1]]
    for dates in (week, d.all_days):
        daily.load_changed(d.spark, database, d.landed, dates, bad_record_limit=0)
    if daily.load_changed(d.spark, database, d.landed, d.all_days).dates:
        raise ValueError("a date was loaded again though none of its files had changed")
    return d.spark.table(f"{database}.raw_events")


def landed_ledger(d: Derived) -> DataFrame:
    """Records per hour as the ledger notes them on loading."""
    database = fresh_database(d.spark, "noted")
    daily.load_changed(d.spark, database, d.landed, d.all_days, bad_record_limit=0)
    noted = d.spark.table(f"{database}.landed_files")
    return noted.groupBy("event_date", "hour_of_day").agg(
        F.sum("records").alias("records"), F.sum("malformed").alias("malformed")
    )


def expire_landed(d: Derived) -> DataFrame:
    """Files that retention leaves; the landing is one of its own."""
    files = mixed_files.anew(d.spark, d.sf_dir)
    landing.expire_landed(d.spark, files, d.last_day, KEEP_DAYS)
    left = ndjson.combine_hours(d.spark, files, landing.list_dates(d.spark, files, ["*"]))
    return left.groupBy(F.col("file_date").alias("event_date")).agg(F.count(F.lit(1)).alias("raw_rows"))


def expire_partitions(d: Derived) -> DataFrame:
    table = f"{stored_raw(d.spark, d.sf_dir, 'expired')}.raw_events"
    tables.expire_partitions(d.spark, table, d.last_day, KEEP_DAYS)
    return tables.raw_row_counts(d.spark.table(table))


def retained(d: Derived) -> DataFrame:
    dated = d.raw.withColumn("event_date", event_date("created_at"))
    return tables.raw_row_counts(tables.retained(dated, d.last_day, KEEP_DAYS))


SOURCES = {
    "scan_ndjson": lambda d: zoneless(scan_plain(d)),
    "scan_gzip": lambda d: zoneless(ndjson.scan_ndjson(d.spark, d.landed.day_glob(d.all_days))),
    "scan_gzip_spread": lambda d: zoneless(
        ndjson.combine_hours(d.spark, d.landed, d.all_days, large_bytes=0).drop("file_date")
    ),
    "hour_paths": hour_paths,
    "bad_record_budget": lambda d: zoneless(bad_record_budget(d)),
    "count_records": lambda d: ndjson.count_records(d.spark, d.landed, d.all_days),
    "combine_hours": combine_hours,
    "hour_window": lambda d: zoneless(hours.hour_window(d.raw, *WINDOW)),
    "hour_window_for_interval": lambda d: zoneless(
        hours.hour_window_for_interval(d.raw, *INTERVAL)
    ),
    "missing_hours": missing_hours,
    "missing_files": missing_files,
    "ensure_table": ensure_table,
    "delete_date": lambda d: zoneless(delete_date(d)),
    "replace_date": lambda d: zoneless(replace_date(d)),
    "replace_date_resumed": lambda d: zoneless(replace_date_resumed(d)),
    "materialize": materialize,
    "backfill": lambda d: zoneless(backfill(d)),
    "backfill_mixed_names": lambda d: zoneless(backfill_mixed_names(d)),
    "load_changed": lambda d: zoneless(load_changed(d)),
    "landed_ledger": landed_ledger,
    "expire_landed": expire_landed,
    "expire_partitions": expire_partitions,
    "retained": retained,
    "raw_row_counts": lambda d: tables.raw_row_counts(d.raw),
}


# -- staging -----------------------------------------------------------------


def json_fields(d: Derived) -> DataFrame:
    return d.raw.select(
        "id",
        "created_at",
        *json_texts("repo", repo_name="name", repo_id="id"),
        *json_texts("actor", actor_login="login", actor_id="id"),
        *json_texts("org", org_login="login"),
    )


def casts(d: Derived) -> DataFrame:
    """Timestamps and booleans that arrive as text."""
    texts = d.raw.select(
        "id",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.col("type"),
        "actor",
        "repo",
        "org",
        "payload",
        F.col("public").cast("string").alias("public"),
    )
    return staging.project_rename(texts)


def stg_from_files(d: Derived, **bound) -> DataFrame:
    database = stored_raw(d.spark, d.sf_dir, "staged")
    return daily.build_staging(d.spark, database, **bound)


STAGING = {
    "required_fields": lambda d: zoneless(staging.required_fields(d.raw)),
    "project_rename": lambda d: zoneless(staging.project_rename(d.raw)),
    "json_fields": lambda d: zoneless(json_fields(d)),
    "timestamp_cast": lambda d: zoneless(casts(d).select("event_id", "event_timestamp")),
    "boolean_cast": lambda d: zoneless(casts(d).select("event_id", "event_timestamp", "is_public")),
    "payload_passthrough": lambda d: staging.stage_events(d.raw).select("event_id", "payload"),
    "dedup_latest": lambda d: zoneless(
        staging.dedup_latest(
            d.raw.filter(F.col("id").isNotNull()), "id", "created_at", ["type", "actor", "payload"]
        )
    ),
    "stg_events": lambda d: zoneless(staging.stage_events(d.raw)),
    "stg_from_files": lambda d: zoneless(stg_from_files(d)),
    "stg_from_files_small_bound": lambda d: zoneless(stg_from_files(d, max_bits=4096)),
}


# -- marts -------------------------------------------------------------------


def distinct_sketches(d: Derived) -> DataFrame:
    """Exact distinct counts, and whether sketches of single dates, merged, come within 2 %."""
    columns = {"actors": "actor_login", "repos": "repo_name"}
    daily_sketches = grouping.distinct_sketches(
        d.stg, [event_date("event_timestamp").alias("event_date")], columns
    )
    merged = grouping.merged_distincts(daily_sketches, [], list(columns))
    exact = grouping.distinct_counts(d.stg, [], columns)
    near = merged.select(*[F.col(c).alias(f"{c}_merged") for c in columns])
    both = exact.unionByName(near, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return one.select(
        *columns,
        *[(F.abs(F.col(f"{c}_merged") - F.col(c)) <= 0.02 * F.col(c)).alias(f"{c}_near") for c in columns],
    )



MARTS = {
    "events_by_type": lambda d: d.by_type,
    "events_by_hour": lambda d: d.by_hour,
    "top_repos": lambda d: d.repos,
    "repo_push_activity": lambda d: marts.repo_push_activity(d.stg),
    "language_trends": lambda d: d.trends,
    "distinct_counts": lambda d: grouping.distinct_counts(
        d.stg, ["org_login"], {"actors": "actor_login", "repos": "repo_name", "types": "event_type"}
    ),
    "distinct_sketches": distinct_sketches,
    "conditional_counts": lambda d: grouping.conditional_counts(
        d.stg, ["actor_login"], "event_type", ACTIVITY_COUNTERS
    ),
    "event_date": lambda d: d.stg.select(
        "event_id", event_date("event_timestamp").alias("event_date")
    ),
    "hour_of_day": lambda d: d.stg.select(
        "event_id", hour_of_day("event_timestamp").alias("hour_of_day")
    ),
    "type_filter": lambda d: d.stg.filter(type_filter("event_type", PUSH_ACTIVITY_TYPES)).select(
        "event_id", "event_type"
    ),
    "split_repo": lambda d: d.stg.select(
        "event_id",
        split_repo("repo_name", 0).alias("repo_owner"),
        split_repo("repo_name", 1).alias("repo_short_name"),
    ),
    "infer_language": lambda d: d.stg.select(
        "event_id", infer_language(split_repo("repo_name", 1)).alias("repo_language")
    ),
    "require_repo": lambda d: marts.require_repo(d.stg).select("event_id", "repo_name"),
    "ordinal_grouping": lambda d: grouping.ordinal_grouping(
        d.stg, [event_date("event_timestamp").alias("event_date"), "repo_name", "org_login"]
    ),
}


# -- report queries ----------------------------------------------------------


def member_days(d: Derived) -> DataFrame:
    return d.spark.table(f"{warehouse(d.spark, d.sf_dir)}.{daily.MEMBER_DAYS}")


def refreshed_uniques(d: Derived) -> DataFrame:
    """Bitmaps written in three refreshes of some dates each, over the whole range."""
    database = stored_raw(d.spark, d.sf_dir, "uniques")
    daily.build_staging(d.spark, database)
    week = landing.days(*WEEK)
    before, after = ([x for x in d.all_days if side(x)] for side in (week[0].__gt__, week[-1].__lt__))
    for days in (before, after, week):
        daily.build_uniques(d.spark, database, days)
    return uniques.range_uniques(
        d.spark.table(f"{database}.{daily.MEMBER_DAYS}"), d.first_day, d.last_day
    )


REPORTS = {
    "date_bounds": lambda d: reports.date_bounds(d.raw),
    "type_range": lambda d: reports.type_range(d.by_type, d.first_day, d.last_day),
    "hour_range": lambda d: reports.hour_range(d.by_hour, d.first_day, d.last_day),
    "top_repo_days": lambda d: reports.top_repo_days(d.repos, d.first_day, d.last_day),
    "language_range": lambda d: d.languages,
    "kpi_totals": lambda d: reports.kpi_totals(d.by_type, d.first_day, d.last_day),
    "kpi_uniques": lambda d: reports.kpi_uniques(d.stg, d.first_day, d.last_day),
    "kpis": lambda d: reports.kpis(d.by_type, d.stg, d.first_day, d.last_day),
    "kpi_uniques_stored": lambda d: uniques.range_uniques(member_days(d), d.first_day, d.last_day),
    "kpi_uniques_week": lambda d: uniques.range_uniques(member_days(d), *WEEK),
    "kpi_uniques_refreshed": refreshed_uniques,
    "kpis_stored": lambda d: uniques.range_kpis(d.by_type, member_days(d), d.first_day, d.last_day),
    "pipeline_status": lambda d: reports.pipeline_status(d.raw),
    "date_range_filter": lambda d: reports.date_range_filter(d.repos, *WEEK),
}


# -- report analytics --------------------------------------------------------


ANALYTICS = {
    "daily_totals": lambda d: analytics.daily_totals(d.by_type),
    "avg_daily": lambda d: analytics.avg_daily(d.by_type),
    "peak_day": lambda d: analytics.peak_day(d.by_type),
    "variability": lambda d: rounded(analytics.variability(d.by_type), "variability"),
    "type_totals": lambda d: analytics.type_totals(d.by_type),
    "dominant_type": lambda d: rounded(analytics.dominant_type(d.by_type), "share"),
    "type_mix_top6": lambda d: analytics.type_mix(d.by_type),
    "type_mix_top4": lambda d: analytics.type_mix(d.by_type, MIX_TYPES),
    "hour_heatmap": lambda d: analytics.hour_heatmap(d.by_hour),
    "hour_pattern": lambda d: analytics.hour_pattern(d.by_hour),
    "repo_rollup": lambda d: d.rollup,
    "short_repo_label": lambda d: marts.require_repo(d.stg)
    .select("repo_name", short_repo_label("repo_name", LABEL_LENGTH).alias("repo_short"))
    .distinct(),
    "most_active_repo": lambda d: analytics.most_active_repo(d.rollup),
    "top10_share": lambda d: rounded(analytics.top_share(d.rollup), "share"),
    "median_repo_events": lambda d: analytics.median_repo_events(d.rollup),
    "top20_repos": lambda d: analytics.top_repo_chart(d.rollup),
    "repo_table": lambda d: analytics.repo_table(d.rollup),
    "repo_breakdown": lambda d: analytics.repo_breakdown(d.rollup),
    "repo_treemap": lambda d: rounded(analytics.repo_treemap(d.rollup), "contributors"),
    "language_totals": lambda d: analytics.language_totals(d.languages),
    "dominant_language": lambda d: rounded(analytics.dominant_language(d.languages), "share"),
    "tracked_languages": lambda d: analytics.tracked_languages(d.languages),
}


# -- data quality ------------------------------------------------------------


def on_raw(*rules: quality.Check) -> Callable[[Derived], DataFrame]:
    """Rules on records that break them: missing ids, repeated ids, and so on."""

    def run(d: Derived) -> DataFrame:
        measured = d.raw.selectExpr(
            "*", "hour(created_at) AS hour_of_day", "hour(created_at) - 12 AS hour_from_noon"
        )
        return quality.run_checks(measured, "raw_events", rules)

    return run


def on_stored(table: str, rule: quality.Check) -> Callable[[Derived], DataFrame]:
    def run(d: Derived) -> DataFrame:
        stored = d.spark.table(f"{warehouse(d.spark, d.sf_dir)}.{table}")
        return quality.run_checks(stored, table, [rule])

    return run


def check_sql(d: Derived) -> DataFrame:
    view = f"check_sql_stg_{uuid.uuid4().hex[:12]}"
    d.stg.createOrReplaceTempView(view)
    query = f"SELECT count(*) FROM {view} WHERE repo_name IS NULL"
    return quality.check_sql(d.spark, query, 0, "events name a repository")


def checks_only(d: Derived) -> DataFrame:
    return daily.checks_only(d.spark, warehouse(d.spark, d.sf_dir))


def stored_states(d: Derived) -> DataFrame:
    return daily.checks_from_states(d.spark, warehouse(d.spark, d.sf_dir))


def unique_from_states(d: Derived) -> DataFrame:
    """Repeated ids of the raw records, which staging has none of, from words by date."""
    raw = d.raw.select(F.col("id").alias("event_id"), event_date("created_at").alias("event_date"))
    words = checkstates.id_words(raw)
    rows = raw.agg(F.count("event_id").alias("rows"), F.lit(0).cast("long").alias("ids"))
    ids = checkstates.distinct_ids(words).select(F.lit(0).cast("long").alias("rows"), "ids")
    both = rows.unionByName(ids).agg(F.sum("rows").alias("rows"), F.sum("ids").alias("ids"))
    return both.withColumn("failures", F.col("rows") - F.col("ids"))


def quality_report(d: Derived) -> DataFrame:
    stg = d.stg.withColumn("event_date", event_date("event_timestamp"))
    return quality.quality_report(
        {
            "stg_events": stg,
            "events_by_type": d.by_type,
            "events_by_hour": d.by_hour,
            "top_repos": d.repos,
            "language_trends": d.trends,
        }
    )


def stored_completeness(d: Derived) -> DataFrame:
    database = warehouse(d.spark, d.sf_dir)
    return quality.hour_completeness(
        d.spark.table(f"{database}.stg_events"), d.spark.table(f"{database}.events_by_hour")
    )


QUALITY = {
    "check_not_null": on_raw(*[quality.not_null(c) for c in ("id", "type", "repo", "org")]),
    "check_unique": on_raw(quality.unique("id")),
    "check_non_negative": on_raw(quality.non_negative("hour_from_noon")),
    "check_positive": on_raw(quality.positive("hour_from_noon")),
    "check_max": on_raw(quality.at_most("hour_of_day", HOUR_LIMIT)),
    "check_sql": check_sql,
    "check_identity_fields": on_stored("stg_events", quality.IDENTITY_FIELDS),
    "check_min_event_types": on_stored("events_by_type", quality.ENOUGH_EVENT_TYPES),
    "check_hour_domain": on_stored("events_by_hour", quality.HOUR_DOMAIN),
    "check_repo_present": on_stored("top_repos", quality.REPO_PRESENT),
    "check_language_rows": on_stored("language_trends", quality.LANGUAGE_ROWS),
    "quality_report": quality_report,
    "gate": lambda d: quality.failed_checks(quality_report(d)),
    "hour_completeness": lambda d: quality.hour_completeness(d.stg, d.by_hour),
    "hour_completeness_stored": stored_completeness,
    "checks_only": checks_only,
    "checks_from_states": stored_states,
    "check_unique_from_states": unique_from_states,
}


def registered() -> dict[str, Query]:
    """All queries by name."""

    def bind(run: Callable[[Derived], DataFrame]) -> Query:
        return lambda spark, sf_dir: run(Derived(spark, sf_dir))

    groups = (SOURCES, STAGING, MARTS, REPORTS, ANALYTICS, QUALITY)
    return {name: bind(run) for group in groups for name, run in group.items()}
