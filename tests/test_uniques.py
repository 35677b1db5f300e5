"""Distinct members of date ranges from numbered names and bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, land, plan, record
from tallyhouse.operators import grouping, uniques
from tallyhouse.operators.reports import kpi_uniques
from tallyhouse.plans import daily
from tallyhouse.plans.dashboard import dashboard
from tallyhouse.sources.landing import Landing, days

SPAN = days("2024-05-01", "2024-05-06")
STG = "event_id string, event_timestamp timestamp, actor_login string, repo_name string"


def staged(spark, seed=0, n=3000, names=70):
    rng = random.Random(seed)
    rows = [
        (str(i), at(f"{rng.choice(SPAN)}T{rng.randrange(24):02d}:00:00"),
         rng.choice([None, "hot", *[f"a{rng.randrange(names)}"] * 3]), rng.choice([None, f"r/{rng.randrange(names)}"]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, STG)


def built(spark, stg, shards=5):
    seen = uniques.members_by_date(stg)
    none = spark.createDataFrame([], "kind string, name string, number long")
    members = uniques.numbered(uniques.new_names(seen, none), none, shards)
    return members.cache(), uniques.member_bitmaps(seen, members)


def test_numbers_are_dense_and_stay(spark):
    stg = staged(spark)
    members, _ = built(spark, stg)
    rows = members.collect()
    for kind, column in uniques.KINDS.items():
        names = {r[0] for r in stg.select(column).distinct().collect()} - {None}
        assert {r.name for r in rows if r.kind == kind} == names
        assert sorted(r.number for r in rows if r.kind == kind) == list(range(1, len(names) + 1))
    more = uniques.members_by_date(staged(spark, seed=1, names=90))
    added = uniques.numbered(uniques.new_names(more, members), members, 3).collect()
    known = {(r.kind, r.name) for r in rows}
    assert added and not known & {(r.kind, r.name) for r in added}
    for kind in uniques.KINDS:
        last = sum(r.kind == kind for r in rows)
        new = sorted(r.number for r in added if r.kind == kind)
        assert new == list(range(last + 1, last + 1 + len(new)))
    members.unpersist()


def test_ranges_equal_counts_of_rows(spark):
    stg = staged(spark)
    members, bitmaps = built(spark, stg)
    bitmaps = bitmaps.cache()
    for i, first in enumerate(SPAN):
        for last in SPAN[i::2]:
            assert uniques.range_uniques(bitmaps, first, last).first() == kpi_uniques(stg, first, last).first()
    assert tuple(uniques.range_uniques(bitmaps, "2020-01-01", "2020-01-02").first()) == (0, 0)
    bitmaps.unpersist()
    members.unpersist()


def test_more_members_than_a_bucket_holds(spark):
    stg = spark.range(70_000).selectExpr(
        "string(id) AS event_id", "timestamp_seconds(1714550400 + (id % 2) * 86400) AS event_timestamp",
        "concat('a', id % 50000) AS actor_login", "'one' AS repo_name",
    )
    members, bitmaps = built(spark, stg, shards=8)
    assert bitmaps.filter("kind = 'actor'").select("bucket").distinct().count() == 2
    assert tuple(uniques.range_uniques(bitmaps, SPAN[0], SPAN[-1]).first()) == (50_000, 1)
    members.unpersist()


def test_no_window_sees_all_names(spark):
    stg = staged(spark, n=50)
    none = spark.createDataFrame([], "kind string, name string, number long")
    text = plan(uniques.numbered(uniques.new_names(uniques.members_by_date(stg), none), none, 4))
    assert "SinglePartition" not in text


@pytest.fixture()
def loaded(spark, database, tmp_path):
    layout = Landing(str(tmp_path))
    types = ("PushEvent", "WatchEvent", "ForkEvent", "IssuesEvent", "CreateEvent")
    for n, day in enumerate(SPAN[:3]):
        docs = [record(f"{day}{i}", f"{day}T{i:02d}:00:00", types[i % 5], actor=f"u{i % (n + 3)}", repo=f"o/r{i % 4}")
                for i in range(20)]
        land(tmp_path, str(day), 0, docs)
    daily.backfill(spark, database, layout, SPAN[0], SPAN[2])
    return layout


def test_stored_ranges_follow_the_loads(spark, database, loaded, tmp_path):
    def both(first, last):
        stored = uniques.range_uniques(spark.table(f"{database}.member_days"), first, last).first()
        assert stored == kpi_uniques(spark.table(f"{database}.stg_events"), first, last).first()
        return tuple(stored)

    assert both(SPAN[0], SPAN[2]) == (5, 4)
    land(tmp_path, str(SPAN[1]), 1, [record("x", f"{SPAN[1]}T05:00:00", actor="zoe", repo="z/z")])
    daily.run_day(spark, database, loaded, SPAN[1], changed_only=True)
    assert both(SPAN[0], SPAN[2]) == (6, 5)
    numbers = {(r.kind, r.name): r.number for r in spark.table(f"{database}.members").collect()}
    land(tmp_path, str(SPAN[1]), 1, [])
    daily.run_day(spark, database, loaded, SPAN[1])
    assert both(SPAN[0], SPAN[2]) == (5, 4)
    assert numbers == {(r.kind, r.name): r.number for r in spark.table(f"{database}.members").collect()}


def test_dashboard_reads_no_staging(spark, database, loaded):
    with dashboard(spark, database, SPAN[0], SPAN[2]) as page:
        assert tuple(page["kpis"].first()) == (60, 5, 5, 4)
        text = plan(page["kpis"])
        assert "stg_events" not in text and "member_days" in text


def test_without_staged_rows(spark, database):
    spark.sql(f"CREATE TABLE {database}.stg_events ({STG}, event_date date) USING parquet PARTITIONED BY (event_date)")
    daily.build_uniques(spark, database)
    assert tuple(uniques.range_uniques(spark.table(f"{database}.member_days"), SPAN[0], SPAN[1]).first()) == (0, 0)
    assert spark.table(f"{database}.members").filter(F.col("number") > 0).isEmpty()


def test_sketches_of_dates_merge_within_two_percent(spark):
    rows = spark.range(60_000).selectExpr(
        "id % 6 AS day", "concat('a', id % 41000) AS actor",
        "if(id % 3 = 0, NULL, concat('r', pmod(hash(id), 900))) AS repo",
    )
    columns = {"actors": "actor", "repos": "repo"}
    stored = grouping.distinct_sketches(rows, ["day"], columns).cache()
    exact = grouping.distinct_counts(rows, [], columns).first()
    near = grouping.merged_distincts(stored, [], list(columns)).first()
    assert all(abs(near[c] - exact[c]) <= 0.02 * exact[c] for c in columns)
    part = grouping.merged_distincts(stored.filter("day IN (1, 4)"), [], ["repos"]).first().repos
    want = rows.filter("day IN (1, 4)").agg(F.count_distinct("repo")).first()[0]
    assert abs(part - want) <= 0.02 * want


def test_sketches_without_values(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x"), (None, "y")], "k string, v string")
    stored = grouping.distinct_sketches(rows, ["k"], {"n": "v"})
    assert dict(map(tuple, grouping.merged_distincts(stored, ["k"], ["n"]).collect())) == {"a": 0, "b": 1, None: 1}
    assert grouping.merged_distincts(stored.limit(0), [], ["n"]).first().n == 0
    assert grouping.merged_distincts(stored.limit(0), ["k"], ["n"]).count() == 0
