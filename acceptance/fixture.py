"""Raw activity records derived from the driver's ``events`` table.

Every event is kept.  The table has no repeated ids, missing values or
repositories, so the adapter adds them by rule, with the same rule in Spark and
in SQL: some events are delivered a second time an hour later, some at the same
instant with another payload, some lose their id, and a repository is made up from
the number in ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the adapter, shared by both engines.
WORDS = (
    "python",
    "javascript",
    "java",
    "go",
    "rust",
    "typescript",
    "ruby",
    "php",
    "cpp",
    "csharp",
    "widget",
    "MongoDB",
)
TYPES = {
    "view": "WatchEvent",
    "click": "PushEvent",
    "purchase": "PullRequestEvent",
    "signup": "CreateEvent",
}
AGAIN_PAYLOAD = '{"delivered":"again"}'
SIGNUP_PAYLOAD = '{"ref_type":"branch","master_branch":"main"}'


EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

_WORD_LIST = ", ".join(f"'{w}'" for w in WORDS)
_TYPE_CASE = " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in TYPES.items())


def _spread(events: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer splits than there are cores.

    The driver's table is one small file, hence one task; a large table has
    splits enough and is left as it is read.
    """
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(cores) if events.rdd.getNumPartitions() < cores else events


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with the landed-record schema, one scan of ``events``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    delivered = _spread(events).selectExpr(
        "*",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        """explode(CASE WHEN event_id % 10 = 0 THEN array(0, 1)
                        WHEN event_id % 15 = 7 THEN array(0, 2) ELSE array(0) END) AS late""",
    )
    return delivered.selectExpr(
        "IF(event_id % 97 <> 0, CAST(event_id AS STRING), NULL) AS id",
        f"""CASE event_type {_TYPE_CASE}
            ELSE IF(user_id % 2 = 0, 'ForkEvent', 'IssuesEvent') END AS type""",
        """concat('{"id":', user_id, ',"login":"user', user_id, '"}') AS actor""",
        f"""IF(k <> 13, concat('{{"id":', k, ',"name":"',
            IF(k % 25 = 0, concat('orphan', k),
               concat('org', k % 9, '/', get(array({_WORD_LIST}), k % {len(WORDS)}), '-', k)),
            '"}}'), NULL) AS repo""",
        f"""CASE WHEN late = 2 THEN '{AGAIN_PAYLOAD}'
            WHEN event_type = 'signup' THEN '{SIGNUP_PAYLOAD}' ELSE props END AS payload""",
        "user_id % 10 <> 0 AS public",
        "CAST(ts AS TIMESTAMP) + make_dt_interval(0, late % 2) AS created_at",
        """IF(k % 9 < 3, concat('{"login":"org', k % 9, '"}'), NULL) AS org""",
    )


RAW_SQL = f"""
delivered AS (
  SELECT event_id, user_id, event_type, props, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 0 AS late FROM events
  UNION ALL
  SELECT event_id, user_id, event_type, props, ts + INTERVAL 1 HOUR,
         CAST(json_extract_string(props, '$.k') AS INTEGER), 1 FROM events WHERE event_id % 10 = 0
  UNION ALL
  SELECT event_id, user_id, event_type, props, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER), 2 FROM events WHERE event_id % 15 = 7
),
raw AS (
  SELECT
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
    CASE event_type {_TYPE_CASE}
      ELSE CASE WHEN user_id % 2 = 0 THEN 'ForkEvent' ELSE 'IssuesEvent' END END AS type,
    '{{"id":' || user_id || ',"login":"user' || user_id || '"}}' AS actor,
    CASE WHEN k <> 13 THEN '{{"id":' || k || ',"name":"' ||
      CASE WHEN k % 25 = 0 THEN 'orphan' || k
           ELSE 'org' || (k % 9) || '/' || ([{_WORD_LIST}])[k % 12 + 1] || '-' || k END
      || '"}}' END AS repo,
    CASE WHEN late = 2 THEN '{AGAIN_PAYLOAD}'
         WHEN event_type = 'signup' THEN '{SIGNUP_PAYLOAD}' ELSE props END AS payload,
    user_id % 10 <> 0 AS public,
    ts AS created_at,
    CASE WHEN k % 9 < 3 THEN '{{"login":"org' || (k % 9) || '"}}' END AS org
  FROM delivered
)"""
