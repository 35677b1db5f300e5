"""Checks of whole tables from states of single dates."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import at, land, plan, record
from tallyhouse.operators import checkstates, quality
from tallyhouse.plans import daily
from tallyhouse.sources.landing import Landing

DAYS = [date(2024, 5, d) for d in (1, 2, 3)]
TYPES = ("PushEvent", "WatchEvent", "ForkEvent", "IssuesEvent", "CreateEvent")
SCHEMAS = {
    "stg_events": "event_date date, event_id string, event_timestamp timestamp, event_type string, "
                  "actor_login string, actor_id string",
    "events_by_type": "event_date date, event_type string, event_count long, unique_actors long, unique_repos long",
    "events_by_hour": "event_date date, hour_of_day int, event_count long",
    "top_repos": "event_date date, repo_name string, total_events long, unique_contributors long",
    "language_trends": "event_date date, repo_name string, push_count long, contributors long",
}
IDS = [None, "0", "7", "007", "12345678901234567890", "99999999999999999", "x", "-3", "1.5", " 7", "63", "64"]


def tables(spark, seed, n=40, types=TYPES):
    rng = random.Random(seed)
    day = lambda: rng.choice([*DAYS, *DAYS, None])
    count = lambda: rng.choice([None, -1, 0, 1, 5])
    text = lambda: rng.choice([None, "a", "b"])
    makers = {
        "stg_events": lambda: (
            day(), rng.choice([*IDS, str(rng.randrange(300))]), rng.choice([None, at("2024-05-01T00:00:00")]),
            rng.choice([None, *types]), text(), text(),
        ),
        "events_by_type": lambda: (day(), rng.choice([None, *types]), count(), count(), count()),
        "events_by_hour": lambda: (day(), rng.choice([None, -1, 3, 24]), count()),
        "top_repos": lambda: (day(), text(), count(), count()),
        "language_trends": lambda: (day(), text(), count(), count()),
    }
    return {name: spark.createDataFrame([make() for _ in range(n)], SCHEMAS[name]) for name, make in makers.items()}


def from_states(dfs):
    states = None
    for name, df in dfs.items():
        part = checkstates.date_states(df, name)
        states = part if states is None else states.unionByName(part)
    words = checkstates.id_words(dfs["stg_events"])
    return sorted(map(str, checkstates.report_from_states(states, words, dfs).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_states_give_the_whole_report(spark, seed):
    dfs = tables(spark, seed, types=TYPES if seed else TYPES[:3])
    assert from_states(dfs) == sorted(map(str, quality.quality_report(dfs).collect()))


def test_empty_tables(spark):
    dfs = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    assert from_states(dfs) == sorted(map(str, quality.quality_report(dfs).collect()))


def test_ids_of_any_form(spark):
    rng = random.Random(1)
    ids = [*IDS, *[str(10**9 + i) for i in range(500)]]
    rows = [(rng.choice(DAYS), rng.choice(ids)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "event_date date, event_id string")
    words = checkstates.id_words(df)
    assert checkstates.distinct_ids(words).first().ids == len({i for _, i in rows} - {None})
    # Neighbouring numbers share a row.
    assert words.filter("event_date = DATE'2024-05-01' AND word > 1000000 AND word < 20000000").count() <= 10


def load(spark, database, root, day, *extra):
    docs = [record(f"{day.day}{i:03d}", f"{day}T{i % 24:02d}:00:00", TYPES[i % 5], actor=f"u{i % 7}") for i in range(30)]
    land(root, str(day), 0, [*docs, *extra])
    return daily.run_day(spark, database, Landing(str(root)), day, changed_only=True)


def report(df):
    return sorted(map(str, df.collect()))


def test_refreshed_states_equal_full_checks(spark, database, tmp_path):
    for day in DAYS:
        load(spark, database, tmp_path, day)
    before = {(r.event_date, r.check_name, r.table_name): r.total
              for r in spark.table(f"{database}.check_states").collect()}
    load(spark, database, tmp_path, DAYS[1], record("odd-id", f"{DAYS[1]}T05:00:00", actor="zoe"))
    assert report(daily.checks_from_states(spark, database)) == report(daily.checks_only(spark, database))
    after = {(r.event_date, r.check_name, r.table_name): r.total
             for r in spark.table(f"{database}.check_states").collect()}
    assert {k[0] for k in after if after[k] != before[k]} == {DAYS[1]}
    text = plan(daily.checks_from_states(spark, database))
    assert "stg_events/" not in text and "top_repos/" not in text


def test_a_repeat_over_dates_is_found(spark, database, tmp_path):
    for day in DAYS[:2]:
        load(spark, database, tmp_path, day)
    # A fault that staging cannot make: the id of one date among the rows of another.
    stg = spark.table(f"{database}.stg_events")
    moved = stg.filter(F.col("event_date") == F.lit(DAYS[0])).limit(1)
    moved.withColumn("event_date", F.lit(DAYS[1])).write.insertInto(f"{database}.stg_events")
    spark.catalog.refreshTable(f"{database}.stg_events")
    daily.build_check_states(spark, database, [DAYS[1]])
    failed = quality.failed_checks(daily.checks_from_states(spark, database)).collect()
    assert [(r.table_name, r.check_name, r.failures) for r in failed] == [("stg_events", "unique", 1)]
    with pytest.raises(quality.QualityError, match="event_id unique: 1"):
        quality.gate(daily.checks_from_states(spark, database))
