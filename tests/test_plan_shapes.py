"""Physical plans of the registered queries hold nothing that fails at scale."""

import re

import pytest

from acceptance import queries as registry
from acceptance.queries import Derived

SMALL = "/root/testdata/sf0.001"
LAZY = {
    **registry.STAGING,
    **registry.MARTS,
    **registry.REPORTS,
    **registry.ANALYTICS,
    "missing_hours": registry.SOURCES["missing_hours"],
    "hour_window_for_interval": registry.SOURCES["hour_window_for_interval"],
    "quality_report": registry.QUALITY["quality_report"],
    "hour_completeness": registry.QUALITY["hour_completeness"],
}
LAZY.pop("stg_from_files")  # writes tables; its plan is tested with staging


def nodes(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"^[\s:+\-|]*", "", line) for line in text.splitlines()]


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    listed = nodes(LAZY[name](Derived(spark, SMALL)))
    text = "\n".join(listed)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapPartitions"):
        assert unwanted not in text
    # A window without a partitioning key would pull everything into one task.
    for node in listed:
        if node.startswith(("Window ", "WindowGroupLimit")):
            assert "[]" not in node.split("windowspecdefinition")[0]
            assert not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", node)


def test_limits_are_top_k_not_sorts(spark):
    derived = Derived(spark, SMALL)
    for name in ("top_repo_days", "pipeline_status", "peak_day", "repo_table"):
        assert any(n.startswith("TakeOrderedAndProject") for n in nodes(LAZY[name](derived)))


def test_shared_staging_is_shuffled_once(spark):
    """The report over unsaved tables reuses one deduplication exchange."""
    report = LAZY["quality_report"](Derived(spark, SMALL))
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 4


def test_unused_columns_are_not_scanned(spark, tmp_path):
    derived = Derived(spark, SMALL)
    path = str(tmp_path / "stg")
    registry.STAGING["stg_events"](derived).write.parquet(path)
    from tallyhouse.operators import marts

    by_hour = marts.events_by_hour(spark.read.parquet(path))
    scan = by_hour._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert scan.startswith("struct<event_timestamp:timestamp_ntz,actor_login:string>")
