"""SQL twins of the registered queries, for DuckDB over the same tables.

Written without the Spark library: each twin states its operator's result in
plain SQL over the shared adapter.
"""

from __future__ import annotations

from acceptance.fixture import RAW_SQL

COMMON = f"""
WITH {RAW_SQL},
staged AS (
  SELECT id AS event_id, created_at AS event_timestamp, type AS event_type,
         json_extract_string(repo, '$.name') AS repo_name,
         json_extract_string(repo, '$.id') AS repo_id,
         json_extract_string(actor, '$.login') AS actor_login,
         json_extract_string(actor, '$.id') AS actor_id,
         json_extract_string(org, '$.login') AS org_login,
         public AS is_public, payload,
         CAST(created_at AS DATE) AS event_date,
         CAST(hour(created_at) AS INTEGER) AS hour_of_day
  FROM raw
  WHERE id IS NOT NULL AND type IS NOT NULL AND created_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC, type DESC,
    json_extract_string(repo, '$.name') DESC NULLS LAST, payload DESC) = 1
),
by_type AS (
  SELECT event_date, event_type, count(*) AS event_count,
         count(DISTINCT actor_login) AS unique_actors, count(DISTINCT repo_name) AS unique_repos
  FROM staged GROUP BY ALL
),
by_hour AS (
  SELECT event_date, hour_of_day, count(*) AS event_count,
         count(DISTINCT actor_login) AS unique_actors
  FROM staged GROUP BY ALL
),
repo_days AS (
  SELECT event_date, repo_name, count(*) AS total_events,
         count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks,
         count(*) FILTER (event_type = 'PushEvent') AS pushes,
         count(*) FILTER (event_type = 'PullRequestEvent') AS pull_requests,
         count(*) FILTER (event_type = 'IssuesEvent') AS issues,
         count(DISTINCT actor_login) AS unique_contributors
  FROM staged WHERE repo_name IS NOT NULL GROUP BY ALL
),
hints AS (
  SELECT * FROM (VALUES
    (1, 'python', 'Python'), (2, 'javascript', 'JavaScript'), (3, 'java', 'Java'), (4, 'go', 'Go'),
    (5, 'rust', 'Rust'), (6, 'typescript', 'TypeScript'), (7, 'ruby', 'Ruby'), (8, 'php', 'PHP'),
    (9, 'cpp', 'C++'), (10, 'csharp', 'C#')) AS h(place, needle, language)
),
short_names AS (
  SELECT DISTINCT string_split(repo_name, '/')[2] AS short_name FROM staged
),
languages AS (
  SELECT short_name, min_by(language, place) AS language
  FROM short_names JOIN hints ON contains(lower(short_name), needle) GROUP BY short_name
),
pushes AS (
  SELECT event_date, string_split(repo_name, '/')[1] AS repo_owner,
         string_split(repo_name, '/')[2] AS repo_short_name, repo_name,
         count(*) AS push_count, count(DISTINCT actor_login) AS contributors
  FROM staged WHERE event_type = 'PushEvent' OR event_type = 'CreateEvent' GROUP BY ALL
),
trends AS (
  SELECT event_date, repo_owner, repo_short_name, repo_name, language AS repo_language,
         push_count, contributors
  FROM pushes LEFT JOIN languages ON repo_short_name = short_name
),
ranked_days AS (
  SELECT * FROM repo_days ORDER BY total_events DESC, event_date, repo_name LIMIT 200
),
rollup_all AS (
  SELECT repo_name, CAST(sum(total_events) AS BIGINT) AS total_events,
         CAST(sum(stars) AS BIGINT) AS stars, CAST(sum(forks) AS BIGINT) AS forks,
         CAST(sum(pushes) AS BIGINT) AS pushes,
         CAST(sum(pull_requests) AS BIGINT) AS pull_requests,
         CAST(sum(issues) AS BIGINT) AS issues,
         CAST(sum(unique_contributors) AS BIGINT) AS unique_contributors
  FROM ranked_days GROUP BY repo_name
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY total_events DESC, repo_name) AS place FROM rollup_all
),
language_days AS (
  SELECT event_date, repo_language, CAST(sum(push_count) AS BIGINT) AS push_count,
         CAST(sum(contributors) AS BIGINT) AS contributors
  FROM trends WHERE repo_language IS NOT NULL GROUP BY ALL
),
day_sums AS (
  SELECT event_date, CAST(sum(event_count) AS BIGINT) AS event_count FROM by_type GROUP BY ALL
),
type_sums AS (
  SELECT event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM by_type GROUP BY ALL
),
language_sums AS (
  SELECT repo_language, CAST(sum(push_count) AS BIGINT) AS push_count,
         CAST(sum(contributors) AS BIGINT) AS contributors
  FROM language_days GROUP BY ALL
)
"""

RAW_COLUMNS = "id, type, actor, repo, payload, public, created_at, org"
STAGING_COLUMNS = (
    "event_id, event_timestamp, event_type, repo_name, repo_id, "
    "actor_login, actor_id, org_login, is_public, payload"
)
PROJECTED = """
SELECT id AS event_id, created_at AS event_timestamp, type AS event_type,
       json_extract_string(repo, '$.name') AS repo_name, json_extract_string(repo, '$.id') AS repo_id,
       json_extract_string(actor, '$.login') AS actor_login,
       json_extract_string(actor, '$.id') AS actor_id,
       json_extract_string(org, '$.login') AS org_login, public AS is_public, payload
FROM raw"""
COUNTS_BY_DATE = "SELECT CAST(created_at AS DATE) AS event_date, count(*) AS raw_rows FROM raw"
GRID = """
SELECT CAST(d AS DATE) AS event_date, CAST(h AS INTEGER) AS hour_of_day
FROM generate_series((SELECT date_trunc('day', min(created_at)) FROM raw), (SELECT date_trunc('day', max(created_at)) FROM raw), INTERVAL 1 DAY) AS g(d),
     range(24) AS r(h)
WHERE NOT EXISTS (SELECT 1 FROM raw WHERE CAST(created_at AS DATE) = CAST(d AS DATE)
                  AND hour(created_at) = h)"""
DATED_RAW = f"SELECT {RAW_COLUMNS}, CAST(created_at AS DATE) AS event_date FROM raw"
LABEL = """
CASE WHEN length(tail) > {n} THEN left(tail, {n} - 3) || '...' ELSE tail END"""
TAIL = "array_to_string(list_slice(string_split(repo_name, '/'), -2, -1), '/')"
SHORT = LABEL.format(n=28).replace("tail", TAIL)
LABELLED = f"(SELECT *, {SHORT} AS repo_short FROM placed)"


def _share(name: str, amount: str, relation: str) -> str:
    return (
        f"SELECT {name}, round({amount} / greatest((SELECT sum({amount}) FROM {relation}), 1), 9) AS share "
        f"FROM {relation} ORDER BY {amount} DESC, {name} LIMIT 1"
    )


def _check(table: str, column: str | None, name: str, failures: str, relation: str) -> str:
    shown = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{table}' AS table_name, {shown} AS column_name, '{name}' AS check_name, "
        f"CAST(({failures}) AS BIGINT) AS failures, ({failures}) = 0 AS passed FROM {relation}"
    )


def _rule(table: str, relation: str, rule: str, column: str) -> str:
    failures = {
        "not_null": f"count(*) - count({column})",
        "unique": f"count({column}) - count(DISTINCT {column})",
        "non_negative": f"count(*) FILTER ({column} < 0)",
        "positive": f"count(*) FILTER ({column} < 1)",
    }[rule]
    return _check(table, column, rule, failures, relation)


CUSTOM = {
    "check_identity_fields": _check(
        "stg_events", None, "core identity fields are present",
        "count(*) FILTER (event_id IS NULL OR actor_login IS NULL OR event_type IS NULL)", "staged",
    ),
    "check_min_event_types": _check(
        "events_by_type", None, "multiple event types exist",
        "CAST(count(DISTINCT event_type) < 5 AS INTEGER)", "by_type",
    ),
    "check_hour_domain": _check(
        "events_by_hour", None, "hours in valid range",
        "count(*) FILTER (hour_of_day NOT BETWEEN 0 AND 23)", "by_hour",
    ),
    "check_repo_present": _check(
        "top_repos", None, "no null repo names", "count(*) - count(repo_name)", "repo_days",
    ),
    "check_language_rows": _check(
        "language_trends", None, "language trend rows exist", "CAST(count(*) = 0 AS INTEGER)", "trends",
    ),
}

REPORT = " UNION ALL ".join(
    [
        *[_rule("stg_events", "staged", "not_null", c) for c in
          ("event_id", "event_timestamp", "event_type", "actor_login", "actor_id")],
        _rule("stg_events", "staged", "unique", "event_id"),
        _rule("events_by_type", "by_type", "not_null", "event_date"),
        _rule("events_by_type", "by_type", "not_null", "event_type"),
        _rule("events_by_type", "by_type", "positive", "event_count"),
        _rule("events_by_type", "by_type", "non_negative", "unique_actors"),
        _rule("events_by_type", "by_type", "non_negative", "unique_repos"),
        _rule("events_by_hour", "by_hour", "not_null", "event_date"),
        _rule("events_by_hour", "by_hour", "not_null", "hour_of_day"),
        _rule("events_by_hour", "by_hour", "non_negative", "hour_of_day"),
        _check("events_by_hour", "hour_of_day", "max", "count(*) FILTER (hour_of_day > 23)", "by_hour"),
        _rule("events_by_hour", "by_hour", "positive", "event_count"),
        _rule("top_repos", "repo_days", "not_null", "event_date"),
        _rule("top_repos", "repo_days", "not_null", "repo_name"),
        _rule("top_repos", "repo_days", "positive", "total_events"),
        _rule("top_repos", "repo_days", "non_negative", "unique_contributors"),
        _rule("language_trends", "trends", "not_null", "event_date"),
        _rule("language_trends", "trends", "not_null", "repo_name"),
        _rule("language_trends", "trends", "positive", "push_count"),
        _rule("language_trends", "trends", "positive", "contributors"),
        *CUSTOM.values(),
    ]
)

RAW_MEASURED = (
    "(SELECT *, hour(created_at) AS hour_of_day, hour(created_at) - 12 AS hour_from_noon FROM raw)"
)
COMPLETENESS = """
SELECT event_date, s.seen AS staging_hours, coalesce(m.seen, 0) AS mart_hours,
       s.seen = 24 AND coalesce(m.seen, 0) = 24 AS complete
FROM (SELECT event_date, count(DISTINCT hour_of_day) AS seen FROM staged GROUP BY ALL) s
LEFT JOIN (SELECT event_date, count(hour_of_day) AS seen FROM by_hour GROUP BY ALL) m USING (event_date)"""
HEATMAP = "SELECT CAST(event_date AS VARCHAR) AS event_date, " + ", ".join(
    f"CAST(coalesce(avg(event_count) FILTER (hour_of_day = {h}), 0) AS DOUBLE) AS hour_{h:02d}"
    for h in range(24)
) + " FROM by_hour GROUP BY event_date"


def _mix(n: int) -> str:
    return (
        "SELECT CAST(event_date AS VARCHAR) AS event_date, event_type, event_count, unique_actors, "
        "unique_repos FROM by_type WHERE event_type IN "
        f"(SELECT event_type FROM type_sums ORDER BY event_count DESC, event_type LIMIT {n})"
    )


STAGED = f"SELECT {STAGING_COLUMNS} FROM staged"
STORED_STAGED = f"SELECT {STAGING_COLUMNS}, event_date FROM staged"
TARGET, STRAY = "DATE '2024-01-10'", "DATE '2024-01-11'"

UNIQUES = """SELECT count(DISTINCT actor_login) AS unique_actors,
    count(DISTINCT repo_name) AS unique_repos FROM staged"""
KPIS = """SELECT count(*) AS total_events, count(DISTINCT event_type) AS event_types,
    count(DISTINCT actor_login) AS unique_actors, count(DISTINCT repo_name) AS unique_repos
    FROM staged"""

TWINS: dict[str, str] = {
    # sources, sinks, load semantics
    "scan_ndjson": f"SELECT {RAW_COLUMNS} FROM raw",
    "scan_gzip": f"SELECT {RAW_COLUMNS} FROM raw",
    "scan_gzip_spread": f"SELECT {RAW_COLUMNS} FROM raw",
    "hour_paths": """SELECT DISTINCT CAST(created_at AS DATE) AS event_date,
        CAST(hour(created_at) AS INTEGER) AS hour_of_day,
        'raw/' || strftime(created_at, '%Y-%m-%d/hours/%H') || '.ndjson' AS hour_path,
        'raw/' || strftime(created_at, '%Y-%m-%d') || '/events.ndjson' AS daily_path FROM raw""",
    "bad_record_budget": f"""SELECT {RAW_COLUMNS} FROM raw
        WHERE NOT (id IS NULL AND CAST(created_at AS DATE) = {TARGET} AND hour(created_at) = 5)""",
    "count_records": """SELECT CAST(created_at AS DATE) AS event_date,
        CAST(hour(created_at) AS INTEGER) AS hour_of_day, count(*) AS records FROM raw GROUP BY ALL""",
    "combine_hours": """SELECT CAST(created_at AS DATE) AS file_date, count(*) AS records,
        count(id) AS ids FROM raw GROUP BY ALL""",
    "hour_window": f"SELECT {RAW_COLUMNS} FROM raw WHERE hour(created_at) IN (5, 6)",
    "hour_window_for_interval": f"""SELECT {RAW_COLUMNS} FROM raw
        WHERE CAST(created_at AS DATE) = DATE '2024-01-05' AND hour(created_at) IN (3, 4, 5, 6, 7)""",
    "missing_hours": GRID,
    "missing_files": GRID,
    "ensure_table": f"{COUNTS_BY_DATE} GROUP BY ALL",
    "delete_date": f"{DATED_RAW} WHERE CAST(created_at AS DATE) <> {TARGET}",
    "replace_date": f"""{DATED_RAW} WHERE CAST(created_at AS DATE) <> {TARGET} OR public
        UNION ALL {DATED_RAW} WHERE CAST(created_at AS DATE) = {STRAY} AND public
        UNION ALL {DATED_RAW} WHERE CAST(created_at AS DATE) = {STRAY} AND public""",
    "replace_date_resumed": f"{DATED_RAW} WHERE CAST(created_at AS DATE) <> {TARGET} OR public",
    "materialize": "SELECT * FROM repo_days",
    "backfill": DATED_RAW,
    "backfill_mixed_names": DATED_RAW,
    "load_changed": DATED_RAW,
    "landed_ledger": """SELECT CAST(created_at AS DATE) AS event_date,
        CAST(hour(created_at) AS INTEGER) AS hour_of_day, count(*) AS records,
        CAST(0 AS BIGINT) AS malformed FROM raw GROUP BY ALL""",
    "expire_landed": f"{COUNTS_BY_DATE} WHERE created_at >= (SELECT max(CAST(created_at AS DATE)) FROM raw) - 20 GROUP BY ALL",
    "expire_partitions": f"{COUNTS_BY_DATE} WHERE created_at >= (SELECT max(CAST(created_at AS DATE)) FROM raw) - 20 GROUP BY ALL",
    "retained": f"{COUNTS_BY_DATE} WHERE created_at >= (SELECT max(CAST(created_at AS DATE)) FROM raw) - 20 GROUP BY ALL",
    "raw_row_counts": f"{COUNTS_BY_DATE} GROUP BY ALL",
    # staging
    "required_fields": f"""SELECT {RAW_COLUMNS} FROM raw
        WHERE id IS NOT NULL AND type IS NOT NULL AND created_at IS NOT NULL""",
    "project_rename": PROJECTED,
    "json_fields": f"""SELECT event_id AS id, event_timestamp AS created_at, repo_name, repo_id,
        actor_login, actor_id, org_login FROM ({PROJECTED})""",
    "timestamp_cast": "SELECT id AS event_id, created_at AS event_timestamp FROM raw",
    "boolean_cast": "SELECT id AS event_id, created_at AS event_timestamp, public AS is_public FROM raw",
    "payload_passthrough": "SELECT event_id, payload FROM staged",
    "dedup_latest": f"""SELECT {RAW_COLUMNS} FROM raw WHERE id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC, type DESC, actor DESC, payload DESC) = 1""",
    "stg_events": STAGED,
    "stg_from_files": STORED_STAGED,
    "stg_from_files_small_bound": STORED_STAGED,
    # marts
    "events_by_type": "SELECT * FROM by_type",
    "events_by_hour": "SELECT * FROM by_hour",
    "top_repos": "SELECT * FROM repo_days",
    "repo_push_activity": "SELECT * FROM pushes",
    "language_trends": "SELECT * FROM trends",
    "distinct_counts": """SELECT org_login, count(DISTINCT actor_login) AS actors,
        count(DISTINCT repo_name) AS repos, count(DISTINCT event_type) AS types FROM staged GROUP BY ALL""",
    "distinct_sketches": """SELECT count(DISTINCT actor_login) AS actors,
        count(DISTINCT repo_name) AS repos, true AS actors_near, true AS repos_near FROM staged""",
    "conditional_counts": """SELECT actor_login,
        count(*) FILTER (event_type = 'WatchEvent') AS stars,
        count(*) FILTER (event_type = 'ForkEvent') AS forks,
        count(*) FILTER (event_type = 'PushEvent') AS pushes,
        count(*) FILTER (event_type = 'PullRequestEvent') AS pull_requests,
        count(*) FILTER (event_type = 'IssuesEvent') AS issues FROM staged GROUP BY ALL""",
    "event_date": "SELECT event_id, event_date FROM staged",
    "hour_of_day": "SELECT event_id, hour_of_day FROM staged",
    "type_filter": """SELECT event_id, event_type FROM staged
        WHERE event_type = 'PushEvent' OR event_type = 'CreateEvent'""",
    "split_repo": """SELECT event_id, string_split(repo_name, '/')[1] AS repo_owner,
        string_split(repo_name, '/')[2] AS repo_short_name FROM staged""",
    "infer_language": """SELECT event_id, language AS repo_language FROM staged
        LEFT JOIN languages ON string_split(repo_name, '/')[2] = short_name""",
    "require_repo": "SELECT event_id, repo_name FROM staged WHERE repo_name IS NOT NULL",
    "ordinal_grouping": """SELECT event_date, repo_name, org_login, count(*) AS row_count
        FROM staged GROUP BY 1, 2, 3""",
    # report queries
    "date_bounds": """SELECT CAST(min(created_at) AS DATE) AS min_date,
        CAST(max(created_at) AS DATE) AS max_date FROM raw""",
    "type_range": "SELECT * FROM by_type",
    "hour_range": "SELECT * FROM by_hour",
    "top_repo_days": "SELECT * FROM ranked_days",
    "language_range": "SELECT * FROM language_days",
    "kpi_totals": """SELECT CAST(sum(event_count) AS BIGINT) AS total_events,
        count(DISTINCT event_type) AS event_types FROM by_type""",
    "kpi_uniques": UNIQUES,
    "kpis": KPIS,
    "kpi_uniques_stored": UNIQUES,
    "kpi_uniques_week": f"""{UNIQUES}
        WHERE event_date >= DATE '2024-01-05' AND event_date <= DATE '2024-01-11'""",
    "kpi_uniques_refreshed": UNIQUES,
    "kpis_stored": KPIS,
    "pipeline_status": f"{COUNTS_BY_DATE} GROUP BY ALL ORDER BY event_date DESC LIMIT 14",
    "date_range_filter": """SELECT * FROM repo_days
        WHERE event_date >= DATE '2024-01-05' AND event_date <= DATE '2024-01-11'""",
    # report analytics
    "daily_totals": "SELECT * FROM day_sums",
    "avg_daily": "SELECT CAST(trunc(avg(event_count)) AS BIGINT) AS avg_daily FROM day_sums",
    "peak_day": "SELECT * FROM day_sums ORDER BY event_count DESC, event_date LIMIT 1",
    "variability": """SELECT round(stddev_samp(event_count) / greatest(trunc(avg(event_count)), 1), 9)
        AS variability FROM day_sums""",
    "type_totals": "SELECT * FROM type_sums",
    "dominant_type": _share("event_type", "event_count", "type_sums"),
    "type_mix_top6": _mix(6),
    "type_mix_top4": _mix(4),
    "hour_heatmap": HEATMAP,
    "hour_pattern": """SELECT hour_of_day, CAST(sum(event_count) AS BIGINT) AS event_count
        FROM by_hour GROUP BY ALL""",
    "repo_rollup": "SELECT * FROM rollup_all",
    "short_repo_label": f"""SELECT DISTINCT repo_name, {LABEL.format(n=12).replace("tail", TAIL)} AS repo_short
        FROM staged WHERE repo_name IS NOT NULL""",
    "most_active_repo": f"SELECT repo_name, repo_short, total_events FROM {LABELLED} WHERE place = 1",
    "top10_share": """SELECT round(sum(total_events) FILTER (place <= 10)
        / greatest(sum(total_events), 1), 9) AS share FROM placed""",
    "median_repo_events": "SELECT CAST(trunc(median(total_events)) AS BIGINT) AS median_events FROM placed",
    "top20_repos": f"SELECT * EXCLUDE (place) FROM {LABELLED} WHERE place <= 20",
    "repo_table": """SELECT repo_name AS "Repository", total_events AS "Events", stars AS "⭐ Stars",
        forks AS "🍴 Forks", pushes AS "📤 Pushes", pull_requests AS "🔀 PRs", issues AS "🐛 Issues",
        unique_contributors AS "👥 Contributors" FROM placed WHERE place <= 30""",
    "repo_breakdown": f"""SELECT repo_name, repo_short, measure, event_count FROM
        (SELECT * FROM {LABELLED} WHERE place <= 10)
        UNPIVOT (event_count FOR measure IN (pushes, stars, forks, pull_requests, issues))""",
    "repo_treemap": """SELECT string_split(repo_name, '/')[-1] AS label,
        CAST(sum(total_events) AS BIGINT) AS total_events,
        round(sum(unique_contributors * total_events) / sum(total_events), 9) AS contributors,
        CAST(sum(pushes) AS BIGINT) AS pushes, CAST(sum(stars) AS BIGINT) AS stars
        FROM placed WHERE place <= 40 GROUP BY 1""",
    "language_totals": "SELECT * FROM language_sums",
    "dominant_language": _share("repo_language", "push_count", "language_sums"),
    "tracked_languages": "SELECT count(*) AS languages FROM language_sums",
    # data quality
    "check_not_null": " UNION ALL ".join(
        _rule("raw_events", RAW_MEASURED, "not_null", c) for c in ("id", "type", "repo", "org")
    ),
    "check_unique": _rule("raw_events", RAW_MEASURED, "unique", "id"),
    "check_non_negative": _rule("raw_events", RAW_MEASURED, "non_negative", "hour_from_noon"),
    "check_positive": _rule("raw_events", RAW_MEASURED, "positive", "hour_from_noon"),
    "check_max": _check(
        "raw_events", "hour_of_day", "max", "count(*) FILTER (hour_of_day > 20)", RAW_MEASURED
    ),
    "check_sql": """SELECT 'events name a repository' AS check_name,
        CAST(count(*) FILTER (repo_name IS NULL) AS VARCHAR) AS value,
        count(*) FILTER (repo_name IS NULL) = 0 AS passed FROM staged""",
    **CUSTOM,
    "quality_report": REPORT,
    "gate": f"SELECT * FROM ({REPORT}) WHERE NOT passed",
    "hour_completeness": COMPLETENESS,
    "hour_completeness_stored": COMPLETENESS,
    "checks_only": REPORT,
    "checks_from_states": REPORT,
    "check_unique_from_states": """SELECT count(id) AS rows, count(DISTINCT id) AS ids,
        count(id) - count(DISTINCT id) AS failures FROM raw""",
}


def oracle_sql() -> dict[str, str]:
    """Complete SQL text by query name."""
    return {name: f"{COMMON} {query}" for name, query in TWINS.items()}
