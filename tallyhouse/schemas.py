"""Column layouts and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must stay exactly as they are: stored data and expected
# results depend on them.
# ---------------------------------------------------------------------------

#: Landed records.  JSON-typed fields stay JSON text until they are read by path.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("org", T.StringType()),
    ]
)

#: Staging column order.
STAGING_COLUMNS = (
    "event_id",
    "event_timestamp",
    "event_type",
    "repo_name",
    "repo_id",
    "actor_login",
    "actor_id",
    "org_login",
    "is_public",
    "payload",
)

#: Fields a record needs to be staged.
REQUIRED_FIELDS = ("id", "type", "created_at")

#: Repository activity counters: output column -> event type counted.
ACTIVITY_COUNTERS = {
    "stars": "WatchEvent",
    "forks": "ForkEvent",
    "pushes": "PushEvent",
    "pull_requests": "PullRequestEvent",
    "issues": "IssuesEvent",
}

#: Event types that make up push activity.
PUSH_ACTIVITY_TYPES = ("PushEvent", "CreateEvent")

#: Language hints, first match wins: lower-case part of the name -> language.
LANGUAGE_HINTS = (
    ("python", "Python"),
    ("javascript", "JavaScript"),
    ("java", "Java"),
    ("go", "Go"),
    ("rust", "Rust"),
    ("typescript", "TypeScript"),
    ("ruby", "Ruby"),
    ("php", "PHP"),
    ("cpp", "C++"),
    ("csharp", "C#"),
)

#: Sort columns inside each date partition of the stored tables.
CLUSTERING = {
    "stg_events": ("event_type", "repo_name"),
    "events_by_type": ("event_type",),
    "events_by_hour": ("hour_of_day",),
    "top_repos": ("repo_name",),
    "language_trends": ("repo_language",),
    "member_days": ("kind", "bucket"),
    "check_states": ("table_name",),
    "check_ids": ("word",),
}

#: Malformed records a load may hold before it is refused.
BAD_RECORD_LIMIT = 100

#: Days of partitions that retention keeps.
RETENTION_DAYS = 30
