"""Edge cases of marts, report queries and analytics on hand-made rows."""

from datetime import date

import pytest

from helpers import at, plan, raw_frame, raw_row
from tallyhouse.operators import analytics, grouping, marts, reports
from tallyhouse.operators.staging import stage_events

D1, D2 = date(2024, 5, 1), date(2024, 5, 2)


@pytest.fixture(scope="module")
def stg(spark):
    raw = raw_frame(
        spark,
        raw_row("1", type="PushEvent", actor="ann", repo="o/go-kit"),
        raw_row("2", type="PushEvent", actor="ann", repo="o/go-kit"),
        raw_row("3", type="WatchEvent", actor="bob", repo="o/go-kit"),
        raw_row("4", type="CreateEvent", actor="cid", repo=None),
        raw_row("5", "2024-05-01T23:59:59", type="IssuesEvent", actor=None, repo="solo"),
        raw_row("6", "2024-05-02T00:00:00", type="PushEvent", actor="bob", repo="solo"),
    )
    return stage_events(raw).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_types(stg):
    got = rows(marts.events_by_type(stg))
    assert (D1, "PushEvent", 2, 1, 1) in got
    assert (D1, "CreateEvent", 1, 1, 0) in got
    assert (D1, "IssuesEvent", 1, 0, 1) in got
    assert (D2, "PushEvent", 1, 1, 1) in got


def test_hours(stg):
    assert rows(marts.events_by_hour(stg)) == [(D1, 10, 4, 3), (D1, 23, 1, 0), (D2, 0, 1, 1)]


def test_repositories(stg):
    assert rows(marts.top_repos(stg)) == [
        (D1, "o/go-kit", 3, 1, 0, 2, 0, 0, 2),
        (D1, "solo", 1, 0, 0, 0, 0, 1, 0),
        (D2, "solo", 1, 0, 0, 1, 0, 0, 1),
    ]


def test_languages_keep_unnamed_repositories(stg):
    assert rows(marts.language_trends(stg)) == sorted(
        [
            (D1, None, None, None, None, 1, 1),
            (D1, "o", "go-kit", "o/go-kit", "Go", 2, 1),
            (D2, "solo", None, "solo", None, 1, 1),
        ],
        key=str,
    )


def test_other_counters_and_types(stg):
    counted = marts.top_repos(stg, {"watched": "WatchEvent"})
    assert counted.columns[-2:] == ["watched", "unique_contributors"]
    assert marts.repo_push_activity(stg, ["WatchEvent"]).count() == 1


def test_grouping_helpers_ignore_nulls_as_values_but_not_as_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, 1)], "k string, v int")
    assert dict(map(tuple, grouping.distinct_counts(df, ["k"], {"n": "v"}).collect())) == {"a": 1, None: 1}
    got = dict(map(tuple, grouping.conditional_counts(df, ["k"], "v", {"ones": 1}).collect()))
    assert got == {"a": 1, None: 2}


def test_marts_use_no_python_and_no_cartesian(stg):
    for build in marts.MARTS.values():
        text = plan(build(stg))
        for word in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
            assert word not in text


def test_range_check(stg):
    with pytest.raises(ValueError):
        reports.date_range_filter(marts.events_by_type(stg), "2024-05-02", "2024-05-01")


def test_bounds_of_nothing(spark):
    empty = raw_frame(spark)
    assert tuple(reports.date_bounds(empty, "2024-05-09").first()) == (date(2024, 5, 9),) * 2
    assert None not in tuple(reports.date_bounds(empty).first())


def test_kpis_of_nothing_are_zero(stg):
    by_type = marts.events_by_type(stg)
    assert tuple(reports.kpis(by_type, stg, "2020-01-01", "2020-01-02").first()) == (0, 0, 0, 0)


def test_kpis_count_people_once(stg):
    row = reports.kpis(marts.events_by_type(stg), stg, D1, D2).first()
    assert row.asDict() == {"total_events": 6, "event_types": 4, "unique_actors": 3, "unique_repos": 2}


def test_status_puts_undated_rows_last(spark):
    raw = raw_frame(spark, raw_row("1"), raw_row("2", None), raw_row("3", "2024-05-02T00:00:00"))
    assert [tuple(r) for r in reports.pipeline_status(raw).collect()] == [(D2, 1), (D1, 1), (None, 1)]
    assert reports.pipeline_status(raw, 2).count() == 2


def test_ties_are_ordered(spark):
    repos = spark.createDataFrame(
        [(D2, "a", 5), (D1, "b", 5), (D1, "a", 5), (D1, "c", 9)],
        "event_date date, repo_name string, total_events long",
    )
    got = [tuple(r)[:2] for r in reports.top_repo_days(repos, D1, D2, 3).collect()]
    assert got == [(D1, "c"), (D1, "a"), (D1, "b")]


@pytest.fixture(scope="module")
def by_type(spark):
    return spark.createDataFrame(
        [(D1, "A", 3, 1, 1), (D1, "B", 4, 1, 1), (D2, "A", 4, 1, 1), (D2, "C", 3, 1, 1)],
        "event_date date, event_type string, event_count long, unique_actors long, unique_repos long",
    )


def test_peak_prefers_the_earlier_day(by_type):
    assert tuple(analytics.peak_day(by_type).first()) == (D1, 7)


def test_average_is_cut(spark, by_type):
    more = by_type.unionAll(spark.createDataFrame([(D2, "D", 1, 0, 0)], by_type.schema))
    assert analytics.avg_daily(more).first()[0] == 7


def test_variability_of_one_day_is_null(by_type):
    assert analytics.variability(by_type.filter("event_date = DATE'2024-05-01'")).first()[0] is None
    assert analytics.variability(by_type).first()[0] == 0.0


def test_leader_of_a_tie_is_the_first_name(spark):
    df = spark.createDataFrame([("B", 2), ("A", 2), ("C", 1)], "event_type string, event_count long")
    assert tuple(analytics.dominant_type(df).first()) == ("A", 0.4)
    assert analytics.dominant_type(df.limit(0)).count() == 0


def test_mix_keeps_the_largest_types(by_type):
    assert {r.event_type for r in analytics.type_mix(by_type, 2).collect()} == {"A", "B"}
    assert analytics.type_mix(by_type, 1).first().event_date in ("2024-05-01", "2024-05-02")


def test_heatmap_has_every_hour(spark):
    by_hour = spark.createDataFrame([(D1, 0, 5), (D1, 23, 2)], "event_date date, hour_of_day int, event_count long")
    row = analytics.hour_heatmap(by_hour).first().asDict()
    assert len(row) == 25 and row["hour_00"] == 5.0 and row["hour_23"] == 2.0 and row["hour_12"] == 0.0


@pytest.fixture(scope="module")
def repo_days(spark):
    schema = "event_date date, repo_name string, " + ", ".join(
        f"{m} long" for m in analytics.REPO_MEASURES
    )
    return spark.createDataFrame(
        [
            (D1, "x/lib", 10, 1, 2, 3, 4, 0, 5),
            (D2, "x/lib", 10, 1, 1, 1, 1, 1, 5),
            (D1, "y/lib", 20, 0, 0, 20, 0, 0, 2),
            (D1, "z", 4, 4, 0, 0, 0, 0, 1),
        ],
        schema,
    )


def test_rollup_adds_people_of_different_days(repo_days):
    got = analytics.repo_rollup(repo_days).collect()
    assert [r.repo_name for r in got] == ["x/lib", "y/lib", "z"]
    assert got[0].unique_contributors == 10 and got[0].forks == 3


def test_repo_figures(repo_days):
    rollup = analytics.repo_rollup(repo_days)
    assert analytics.most_active_repo(rollup).first().repo_short == "x/lib"
    assert analytics.top_share(rollup, 1).first().share == pytest.approx(20 / 44)
    assert analytics.median_repo_events(rollup).first()[0] == 20
    assert [r.repo_name for r in analytics.top_repo_chart(rollup, 2).collect()] == ["y/lib", "x/lib"]
    assert analytics.repo_table(rollup, 1).columns[0] == "Repository"
    assert analytics.repo_breakdown(rollup, 2).count() == 10


def test_boxes_with_one_label_merge(repo_days):
    boxes = {r.label: r for r in analytics.repo_treemap(analytics.repo_rollup(repo_days)).collect()}
    assert boxes["lib"].total_events == 40
    assert boxes["lib"].contributors == pytest.approx((10 * 20 + 2 * 20) / 40)
    assert boxes["z"].contributors == 1


def test_share_of_nothing(repo_days):
    empty = analytics.repo_rollup(repo_days.limit(0))
    assert analytics.top_share(empty).first().share is None
    assert analytics.median_repo_events(empty).first()[0] is None


def test_instants_are_read_in_utc(spark):
    df = spark.createDataFrame([(at("2024-05-01T23:30:00"),)], "event_timestamp timestamp")
    assert marts.dated(df).first().event_date == D1
