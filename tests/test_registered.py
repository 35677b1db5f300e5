"""Every registered query against its SQL twin, and the known totals."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from acceptance import compare as side_by_side
from acceptance.queries import WEEK, Derived, registered
from tallyhouse.operators import analytics, reports

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return side_by_side.duck(SMALL)


def test_every_query_has_a_twin():
    assert set(registered()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_twin(spark, connection, name):
    assert side_by_side.compare(spark, connection, name, SMALL) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_comparison_notices_a_difference(spark, connection, monkeypatch):
    twins = dict(oracle_sql())
    twins["kpis"] = twins["kpis"].replace("count(*) AS total_events", "count(*) + 1 AS total_events")
    monkeypatch.setattr(side_by_side, "oracle_sql", lambda: twins)
    assert "values" in side_by_side.compare(spark, connection, "kpis", SMALL)


@pytest.fixture(scope="module")
def medium(spark):
    derived = Derived(spark, MEDIUM)
    for name in ("stg", "by_type", "by_hour", "repos", "trends"):
        setattr(derived, name, getattr(derived, name).cache())
    yield derived
    for name in ("stg", "by_type", "by_hour", "repos", "trends"):
        getattr(derived, name).unpersist()


def test_known_row_counts(medium):
    assert medium.raw.count() == 11_667  # 1,000 copies an hour later, 667 at the same instant
    assert medium.stg.count() == 9_896
    assert medium.by_type.count() == 181
    assert medium.by_hour.count() == 721
    assert medium.repos.count() == 2_861
    assert medium.trends.count() == 2_233


def test_totals_agree_across_marts(medium):
    staged = medium.stg.count()
    for mart in (medium.by_type, medium.by_hour):
        assert mart.agg({"event_count": "sum"}).first()[0] == staged


def test_known_week(medium):
    assert reports.type_range(medium.by_type, *WEEK).count() == 42
    assert reports.hour_range(medium.by_hour, *WEEK).count() == 168
    assert reports.top_repo_days(medium.repos, *WEEK).count() == 200
    assert reports.language_range(medium.trends, *WEEK).count() == 70


def test_known_figures(medium):
    assert analytics.avg_daily(medium.by_type).first().avg_daily == 319
    assert analytics.variability(medium.by_type).first().variability == pytest.approx(0.190225934)
    peak = analytics.peak_day(medium.by_type).first()
    assert (str(peak.event_date), peak.event_count) == ("2024-01-01", 359)
    leader = analytics.dominant_type(medium.by_type).first()
    assert leader.event_type == "CreateEvent" and leader.share == pytest.approx(0.201899757)
    rollup = medium.rollup
    assert rollup.count() == 92
    assert analytics.median_repo_events(rollup).first()[0] == 14
    assert analytics.top_share(rollup).first().share == pytest.approx(0.204353933)
    language = analytics.dominant_language(medium.languages).first()
    assert language.repo_language == "Go" and language.share == pytest.approx(0.192584076)
