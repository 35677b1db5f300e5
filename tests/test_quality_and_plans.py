"""Checks that find seeded faults, gates, and whole runs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import land, record
from tallyhouse.operators import quality
from tallyhouse.plans import daily
from tallyhouse.sources.landing import Landing

TYPES = ("PushEvent", "WatchEvent", "ForkEvent", "IssuesEvent", "CreateEvent")


def failures(report):
    return {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect() if not r.passed}


def test_there_are_29_checks():
    listed = [c for checks in quality.TABLE_CHECKS.values() for c in checks]
    assert len(listed) == 29
    assert sum(c.column is not None for c in listed) == 24


SEEDED = {
    "stg_events": (
        "event_id string, event_timestamp timestamp, event_type string, actor_login string, actor_id string",
        [("1", None, "A", "x", "1"), ("1", None, None, "x", "1"), (None, None, "A", None, None)],
        {
            ("event_id", "not_null"): 1,
            ("event_id", "unique"): 1,
            ("event_timestamp", "not_null"): 3,
            ("event_type", "not_null"): 1,
            ("actor_login", "not_null"): 1,
            ("actor_id", "not_null"): 1,
            (None, "core identity fields are present"): 2,
        },
    ),
    "events_by_type": (
        "event_date date, event_type string, event_count long, unique_actors long, unique_repos long",
        [(None, None, 0, -1, -1), (None, "A", None, None, None)],
        {
            ("event_date", "not_null"): 2,
            ("event_type", "not_null"): 1,
            ("event_count", "positive"): 1,
            ("unique_actors", "non_negative"): 1,
            ("unique_repos", "non_negative"): 1,
            (None, "multiple event types exist"): 1,
        },
    ),
    "events_by_hour": (
        "event_date date, hour_of_day int, event_count long",
        [(None, 24, 0), (None, -1, 1), (None, None, 1)],
        {
            ("event_date", "not_null"): 3,
            ("hour_of_day", "not_null"): 1,
            ("hour_of_day", "non_negative"): 1,
            ("hour_of_day", "max"): 1,
            ("event_count", "positive"): 1,
            (None, "hours in valid range"): 2,
        },
    ),
    "top_repos": (
        "event_date date, repo_name string, total_events long, unique_contributors long",
        [(None, None, 0, -1)],
        {
            ("event_date", "not_null"): 1,
            ("repo_name", "not_null"): 1,
            ("total_events", "positive"): 1,
            ("unique_contributors", "non_negative"): 1,
            (None, "no null repo names"): 1,
        },
    ),
    "language_trends": (
        "event_date date, repo_name string, push_count long, contributors long",
        [(None, None, 0, -1)],
        {
            ("event_date", "not_null"): 1,
            ("repo_name", "not_null"): 1,
            ("push_count", "positive"): 1,
            ("contributors", "positive"): 1,
        },
    ),
}


@pytest.mark.parametrize("table", SEEDED)
def test_seeded_faults_fail_the_right_checks(spark, table):
    schema, rows, expected = SEEDED[table]
    report = quality.quality_report({table: spark.createDataFrame(rows, schema)})
    assert {k[1:]: n for k, n in failures(report).items()} == expected


def test_an_empty_language_table_fails(spark):
    schema = SEEDED["language_trends"][0]
    report = quality.quality_report({"language_trends": spark.createDataFrame([], schema)})
    assert {k[2] for k in failures(report)} == {"language trend rows exist"}


def test_one_aggregate_per_table(spark):
    schema, rows, _ = SEEDED["stg_events"]
    report = quality.quality_report({"stg_events": spark.createDataFrame(rows, schema)})
    text = report._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LocalRelation") + text.count("LogicalRDD") == 1


def test_gate(spark):
    schema, rows, _ = SEEDED["top_repos"]
    report = quality.quality_report({"top_repos": spark.createDataFrame(rows, schema)})
    with pytest.raises(quality.QualityError, match="top_repos.repo_name not_null: 1 failures"):
        quality.gate(report)
    quality.gate(report.filter("passed"))


def test_sql_check(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert quality.check_sql(spark, "SELECT count(*) FROM five", 5).first().passed
    assert not quality.check_sql(spark, "SELECT count(*) FROM five", 0).first().passed
    assert not quality.check_sql(spark, "SELECT max(id) FROM five WHERE id > 9", 0).first().passed


# -- runs ---------------------------------------------------------------------


def land_day(root, day, hours=range(24), tag=""):
    for hour in hours:
        docs = [
            record(f"{tag}{day}-{hour}-{t}", f"{day}T{hour:02d}:15:00", t, actor=f"u{hour % 3}", repo=f"o/go-{t}")
            for t in TYPES
        ]
        land(root, day, hour, docs, suffix="json.gz" if hour % 2 else "ndjson")


def snapshot(spark, database):
    names = ("stg_events", "events_by_type", "events_by_hour", "top_repos", "language_trends")
    return {n: sorted(map(str, spark.table(f"{database}.{n}").collect())) for n in names}


def test_a_day_end_to_end(spark, database, tmp_path):
    land_day(tmp_path, "2024-05-01")
    layout = Landing(str(tmp_path))
    result = daily.run_day(spark, database, layout, "2024-05-01")
    assert result.rows_loaded == 24 * len(TYPES)
    assert result.source.endswith("/2024-05-01/hours")
    assert spark.table(f"{database}.stg_events").count() == 120
    report = daily.checks_only(spark, database)
    assert report.count() == 29 and not failures(report)
    stored = daily.stored_tables(spark, database)
    row = quality.hour_completeness(stored["stg_events"], stored["events_by_hour"]).first()
    assert (row.staging_hours, row.mart_hours, row.complete) == (24, 24, True)
    before = snapshot(spark, database)
    daily.run_day(spark, database, layout, "2024-05-01")
    assert snapshot(spark, database) == before


def test_a_run_takes_every_landed_hour_and_reports_gaps(spark, database, tmp_path):
    land_day(tmp_path, "2024-05-01", hours=range(13))
    daily.run_day(spark, database, Landing(str(tmp_path)), "2024-05-01")
    stored = daily.stored_tables(spark, database)
    row = quality.hour_completeness(stored["stg_events"], stored["events_by_hour"]).first()
    assert (row.staging_hours, row.mart_hours, row.complete) == (13, 13, False)


def test_a_failed_staging_check_stops_the_marts(spark, database, tmp_path):
    land(tmp_path, "2024-05-01", 0, [record("1", "2024-05-01T00:00:00", actor=None)])
    with pytest.raises(quality.QualityError, match="actor_login"):
        daily.run_day(spark, database, Landing(str(tmp_path)), "2024-05-01")
    assert spark.catalog.tableExists(f"{database}.stg_events")
    assert not spark.catalog.tableExists(f"{database}.events_by_type")


def test_a_day_without_files_builds_nothing(spark, database, tmp_path):
    assert daily.run_day(spark, database, Landing(str(tmp_path)), "2024-05-01").rows_loaded == 0
    assert not spark.catalog.tableExists(f"{database}.stg_events")


def test_backfill_equals_single_days(spark, tmp_path):
    from acceptance.warehouse import fresh_database

    span = ["2024-05-01", "2024-05-02", "2024-05-03"]
    for day in span:
        land_day(tmp_path, day, hours=range(0, 24, 6))
    land(tmp_path, span[0], 23, [
        record("late", "2024-05-02T00:00:01", "PushEvent"),
        record("late", "2024-05-01T23:59:59", "WatchEvent"),
    ])
    layout = Landing(str(tmp_path))
    outcomes = []
    for mode in ("days", "range", "pairs"):
        database = fresh_database(spark, mode)
        if mode == "days":
            for day in span:
                daily.run_day(spark, database, layout, day)
        else:
            step = 2 if mode == "pairs" else None
            results = daily.backfill(spark, database, layout, span[0], span[-1], days_per_load=step)
            assert [d for r in results for d in r.dates] == [date.fromisoformat(d) for d in span]
        outcomes.append(snapshot(spark, database))
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_changed_only_runs_equal_full_ones(spark, tmp_path):
    from acceptance.warehouse import fresh_database

    span = ["2024-05-01", "2024-05-02", "2024-05-03"]
    for day in span:
        land_day(tmp_path, day, hours=range(0, 24, 6))
    # An older copy of a record of the first day arrives on the third, then goes.
    moving = f"{span[0]}-0-PushEvent"
    land(tmp_path, span[2], 5, [record(moving, f"{span[2]}T05:00:00", "ForkEvent")])
    layout = Landing(str(tmp_path))
    outcomes = []
    for changed_only in (False, True):
        database = fresh_database(spark, "changed")
        for day in span:
            daily.run_day(spark, database, layout, day, changed_only=changed_only)
        outcomes.append(snapshot(spark, database))
    assert outcomes[0] == outcomes[1]
    land(tmp_path, span[2], 5, [])
    result = daily.run_day(spark, database, layout, span[2], changed_only=True)
    assert [str(d) for d in result.changed_dates] == [span[2]]
    kept = spark.table(f"{database}.stg_events").filter(f"event_id = '{moving}'").collect()
    assert [(str(r.event_date), r.event_type) for r in kept] == [(span[0], "PushEvent")]


def test_retention_covers_every_table(spark, database, tmp_path):
    span = ["2024-05-01", "2024-05-02", "2024-05-03"]
    for day in span:
        land_day(tmp_path, day, hours=[3])
    daily.backfill(spark, database, Landing(str(tmp_path)), span[0], span[-1])
    dropped = daily.expire(spark, database, span[-1], keep_days=1)
    assert len(dropped) == 9
    assert {tuple(map(str, days)) for days in dropped.values()} == {(span[0],)}
    for name, table in daily.stored_tables(spark, database).items():
        assert {str(r.event_date) for r in table.collect()} == set(span[1:]), name
    before = snapshot(spark, database)
    daily.rebuild(spark, database)
    assert snapshot(spark, database) == before


def test_staging_rows_keep_their_files(spark, database, tmp_path):
    """The stored path writes staging without a shuffle of whole records."""
    land_day(tmp_path, "2024-05-01", hours=range(4))
    daily.load_dates(spark, database, Landing(str(tmp_path)), ["2024-05-01"])
    stg = daily.build_staging(spark, database)
    assert stg.count() == 20
    assert stg.filter(F.col("event_date") != F.to_date("event_timestamp")).count() == 0
