import pytest

from acceptance.queries import Derived
from acceptance.warehouse import day_bounds, stored_raw, warehouse
from tallyhouse.operators import analytics, reports
from tallyhouse.plans.dashboard import available_range, dashboard
from tallyhouse.sources.tables import ensure_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(spark):
    return warehouse(spark, SMALL)


def values(df):
    return sorted(map(str, df.collect()))


def test_whole_range_equals_the_operators(spark, database):
    d = Derived(spark, SMALL)
    first, last = available_range(spark, database)
    assert str(first) == day_bounds(spark, SMALL)[0]
    with dashboard(spark, database) as page:
        assert values(page["events_by_type"]) == values(d.by_type)
        assert values(page["repo_rollup"].select(*d.rollup.columns)) == values(d.rollup)
        assert values(page["language_totals"]) == values(analytics.language_totals(d.languages))
        kpis = reports.kpis(d.by_type, d.stg, *day_bounds(spark, SMALL))
        assert values(page["kpis"]) == values(kpis)
        for name, df in page.items():
            assert df.count() > 0, name


def test_narrow_range_reads_only_its_partitions(spark, database):
    with dashboard(spark, database, "2024-01-05", "2024-01-06") as page:
        dates = {str(r.event_date) for r in page["daily_totals"].collect()}
        assert dates == {"2024-01-05", "2024-01-06"}
        plan = page["kpis"]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [isnotnull(event_date") >= 2


def test_inputs_are_let_go(spark, database):
    with dashboard(spark, database, "2024-01-05", "2024-01-06") as page:
        kept = page["top_repo_days"]
        assert kept.is_cached
    assert not kept.is_cached


def test_an_empty_range_gives_zeros(spark, database):
    with dashboard(spark, database, "2020-01-01", "2020-01-02") as page:
        assert tuple(page["kpis"].first()) == (0, 0, 0, 0)
        assert page["dominant_type"].count() == 0
        assert page["tracked_languages"].first()[0] == 0


def test_range_of_an_empty_table(spark):
    name = stored_raw(spark, SMALL, "emptied")
    ensure_table(spark, f"{name}.raw_events")
    spark.sql(f"TRUNCATE TABLE {name}.raw_events")
    first, last = available_range(spark, name, "2024-02-03")
    assert (str(first), str(last)) == ("2024-02-03", "2024-02-03")
