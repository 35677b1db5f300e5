"""Landed files, the raw table and loads that replace dates."""

import gzip
import itertools
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import land, raw_frame, raw_row, record
from tallyhouse.operators.hours import hour_window_for_interval
from tallyhouse.operators.staging import stage_events
from tallyhouse.plans import daily
from tallyhouse.plans.daily import load_dates
from tallyhouse.sources.landing import (
    Landing,
    days,
    expire_landed,
    landed_hours,
    list_hours,
    missing_hours,
)
from tallyhouse.sources.ndjson import (
    is_large_gzip,
    CORRUPT,
    BadRecordsError,
    bad_record_budget,
    combine_hours,
    count_records,
    scan_ndjson,
)
from tallyhouse.sources.tables import (
    delete_date,
    ensure_table,
    expire_partitions,
    materialize,
    raw_row_counts,
    replace_date,
    replace_dates,
    retained,
    stored_dates,
)

DAY = "2024-05-01"
NEXT = "2024-05-02"


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


# -- scans --------------------------------------------------------------------


def test_layout():
    layout = Landing("s3://lake/raw/")
    assert layout.hour_path(DAY, 5) == "s3://lake/raw/2024-05-01/hours/05.ndjson"
    assert layout.hour_paths(DAY, 5, 2)[1].endswith("/06.ndjson")
    assert layout.daily_path(DAY) == "s3://lake/raw/2024-05-01/events.ndjson"
    assert layout.day_glob([DAY]) == "s3://lake/raw/2024-05-01/hours"
    assert layout.day_glob([DAY, NEXT]) == "s3://lake/raw/{2024-05-01,2024-05-02}/hours"
    assert layout.hour_of("x/2024-05-01/hours/07.json.gz") == (date(2024, 5, 1), 7)
    assert layout.hour_of("x/2024-05-01/hours/notes.txt") is None


def test_archive_layout(spark, database, tmp_path):
    layout = Landing.archive(str(tmp_path))
    assert layout.hour_path(DAY, 3).endswith("/2024-05-01-3.json.gz")
    assert layout.hour_of("a/2024-05-01-3.json.gz") == (date(2024, 5, 1), 3)
    assert layout.hour_of("a/2024-05-01-13.json.gz") == (date(2024, 5, 1), 13)
    for day, hour in ((DAY, 3), (DAY, 13), (NEXT, 0), ("2024-05-03", 1)):
        line = json.dumps(record(f"{day}-{hour}", f"{day}T{hour:02d}:00:00")) + "\n"
        (tmp_path / f"{day}-{hour}.json.gz").write_bytes(gzip.compress(line.encode()))
    result = load_dates(spark, database, layout, [DAY, NEXT])
    assert result.rows_by_date == {date(2024, 5, 1): 2, date(2024, 5, 2): 1}


def test_one_file_per_date_layout(spark, tmp_path):
    path = Landing(str(tmp_path)).daily_path(DAY)
    (tmp_path / DAY).mkdir()
    (tmp_path / DAY / "events.ndjson").write_text(json.dumps(record("1")) + "\n")
    assert ids(scan_ndjson(spark, path)) == ["1"]


def test_a_stray_loaded_twice_is_staged_once(spark, table):
    batch = raw_frame(spark, raw_row("1"), raw_row("stray", f"{NEXT}T01:00:00"))
    for _ in range(2):
        replace_date(batch, table, DAY)
    assert spark.table(table).filter("id = 'stray'").count() == 2
    assert stage_events(spark.table(table)).filter("event_id = 'stray'").count() == 1


def test_blank_and_malformed_lines(spark, tmp_path):
    land(tmp_path, DAY, 0, [record("1")], extra_lines=["", "   ", "{bad json"])
    path = Landing(str(tmp_path)).hour_path(DAY, 0)
    assert ids(scan_ndjson(spark, path)) == ["1"]
    scan = scan_ndjson(spark, path, keep_corrupt=True)
    assert [r[CORRUPT] for r in scan.collect() if r[CORRUPT]] == ["{bad json"]


def test_wrong_types_are_malformed(spark, tmp_path):
    wrong = [{**record("2"), "public": "maybe"}, {**record("3"), "created_at": "soon"}]
    land(tmp_path, DAY, 0, [record("1"), *wrong])
    scan = scan_ndjson(spark, Landing(str(tmp_path)).hour_path(DAY, 0), keep_corrupt=True)
    assert ids(bad_record_budget(scan)) == ["1"]
    with pytest.raises(BadRecordsError):
        bad_record_budget(scan, limit=1)


def test_unknown_fields_are_dropped_and_json_text_kept(spark, tmp_path):
    doc = record("1", payload={"size": 2, "commits": [{"sha": "x"}]}, novelty={"a": 1})
    land(tmp_path, DAY, 0, [doc])
    row = scan_ndjson(spark, Landing(str(tmp_path)).hour_path(DAY, 0)).first()
    assert "novelty" not in row.asDict()
    assert '"commits"' in row.payload and row.org is None


def test_gzip_gives_the_same_rows(spark, tmp_path):
    docs = [record(str(n)) for n in range(5)]
    land(tmp_path / "plain", DAY, 1, docs)
    land(tmp_path / "packed", DAY, 1, docs, suffix="json.gz")
    plain = combine_hours(spark, Landing(str(tmp_path / "plain")), [DAY])
    packed = combine_hours(spark, Landing(str(tmp_path / "packed")), [DAY])
    assert sorted(plain.collect()) == sorted(packed.collect())


def test_combining_skips_absent_hours_and_days(spark, tmp_path):
    land(tmp_path, DAY, 0, [record("1")])
    land(tmp_path, DAY, 7, [record("2")], suffix="json.gz")
    layout = Landing(str(tmp_path))
    assert ids(combine_hours(spark, layout, [DAY])) == ["1", "2"]
    both = combine_hours(spark, layout, [DAY, NEXT])
    assert {r.file_date for r in both.collect()} == {date(2024, 5, 1)}
    assert combine_hours(spark, layout, [NEXT]).count() == 0


def test_parsing_moves_nothing(spark, tmp_path):
    for day, hour in itertools.product((DAY, NEXT), (0, 1)):
        land(tmp_path, day, hour, [record("1")])
    scan = combine_hours(spark, Landing(str(tmp_path)), [DAY, NEXT], keep_corrupt=True)
    assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()


def test_large_gzip_hours_are_spread(spark, tmp_path):
    for hour in (0, 1):
        land(tmp_path, DAY, hour, [record(f"s{hour}")], suffix="json.gz")
    land(tmp_path, DAY, 2, [record(f"p{n}") for n in range(4000)])
    big = [record(f"b{n}", payload={"text": "x%d" % (n * 7919) * 30}) for n in range(20000)]
    land(tmp_path, NEXT, 3, big, suffix="json.gz", extra_lines=["{broken"])
    landing, days = Landing(str(tmp_path)), [DAY, NEXT]
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        spread = combine_hours(spark, landing, days, keep_corrupt=True, large_bytes=50_000)
        spread.write.parquet(str(tmp_path / "out"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.parquet(str(tmp_path / "out"))
    places = out.select("file_date", F.col("_metadata.file_path").alias("place")).distinct()
    by_date = places.groupBy("file_date").agg(F.count(F.lit(1)).alias("files"))
    files = {r.file_date: r.files for r in by_date.collect()}
    assert files[date(2024, 5, 2)] > 2
    whole = combine_hours(spark, landing, days, keep_corrupt=True)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("large", [False, True])
def test_each_branch_lists_its_own_files(spark, tmp_path, large):
    for hour in (0, 1):
        land(tmp_path, DAY, hour, [record(f"s{hour}")], suffix="json.gz")
    land(tmp_path, DAY, 2, [record(f"b{n}") for n in range(3000)], suffix="json.gz")
    land(tmp_path, DAY, 3, [record(f"p{n}") for n in range(3000)])
    wanted = is_large_gzip(5_000)
    scan = scan_ndjson(spark, Landing(str(tmp_path)).day_glob([DAY]))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = scan.filter(wanted if large else ~wanted)._jdf.queryExecution()
        assert execution.toRdd().count() == (3000 if large else 3002)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    leaf = execution.executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numFiles").value() == (1 if large else 3)


def test_instant_filters_reach_the_scan(spark, table):
    fill(spark, table, raw_row("1", f"{DAY}T05:00:00"), raw_row("2", f"{NEXT}T05:00:00"))
    rows = hour_window_for_interval(spark.table(table), f"{DAY}T04:00:00Z", f"{DAY}T06:00:00Z")
    assert ids(rows) == ["1"]
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "GreaterThanOrEqual(created_at" in text and "LessThan(created_at" in text


def test_record_counts(spark, tmp_path):
    land(tmp_path, DAY, 0, [record("1"), record("2")], extra_lines=["", " "])
    land(tmp_path, DAY, 3, [record("3")], suffix="json.gz")
    counts = count_records(spark, Landing(str(tmp_path)), [DAY]).collect()
    assert {(r.hour_of_day, r.records) for r in counts} == {(0, 2), (3, 1)}


def test_missing_hours(spark, tmp_path):
    for hour in range(13):
        land(tmp_path, DAY, hour, [record(str(hour))])
    layout = Landing(str(tmp_path))
    landed = landed_hours(spark, layout, [DAY])
    left = missing_hours(landed, DAY, DAY).collect()
    assert sorted(r.hour_of_day for r in left) == list(range(13, 24))
    assert missing_hours(landed, DAY, DAY, 2, 5).count() == 0
    assert list_hours(spark, layout, [NEXT]) == []
    assert missing_hours(landed_hours(spark, layout, [NEXT]), DAY, NEXT).count() == 48


@pytest.mark.parametrize("bad, fails", [(100, False), (101, True)])
def test_bad_record_limit(spark, database, tmp_path, bad, fails):
    land(tmp_path, DAY, 0, [record("1", f"{DAY}T01:00:00")], extra_lines=["{oops"] * bad)
    layout = Landing(str(tmp_path))
    if fails:
        with pytest.raises(BadRecordsError):
            load_dates(spark, database, layout, [DAY])
        assert spark.table(f"{database}.raw_events").count() == 0
    else:
        assert load_dates(spark, database, layout, [DAY]).rows_loaded == 1


def test_scratch_is_removed(spark, database, tmp_path):
    from pathlib import Path

    from tallyhouse.session import shared_dir

    land(tmp_path, DAY, 0, [record("1")], extra_lines=["{oops"] * 101)
    with pytest.raises(BadRecordsError):
        load_dates(spark, database, Landing(str(tmp_path)), [DAY])
    root = Path(shared_dir(spark).removeprefix("file:"))
    assert not list(root.glob("tallyhouse/parsed-hours-*"))


# -- the raw table --------------------------------------------------------------


@pytest.fixture()
def table(spark, database):
    name = f"{database}.raw_events"
    ensure_table(spark, name)
    return name


def fill(spark, table, *rows):
    df = raw_frame(spark, *rows).withColumn("event_date", F.to_date("created_at"))
    df.write.insertInto(table)


def content(spark, table):
    spark.catalog.refreshTable(table)
    return sorted((r.id, str(r.event_date)) for r in spark.table(table).collect())


def test_ensure_leaves_an_existing_table(spark, table):
    fill(spark, table, raw_row("1"))
    ensure_table(spark, table)
    assert spark.table(table).count() == 1
    assert spark.table(table).schema["event_date"].dataType.simpleString() == "date"


def test_delete_one_date(spark, table):
    fill(spark, table, raw_row("1"), raw_row("2"), raw_row("3", f"{NEXT}T00:00:00"), raw_row("4", None))
    assert delete_date(spark, table, DAY) == 2
    assert content(spark, table) == [("3", NEXT), ("4", "None")]
    assert delete_date(spark, table, "2020-01-01") == 0


def test_replacing_is_safe_to_repeat(spark, table):
    fill(spark, table, raw_row("old"), raw_row("n", f"{NEXT}T00:00:00"), raw_row("u", None))
    batch = raw_frame(spark, raw_row("new"), raw_row("stray", f"{NEXT}T01:00:00"))
    for turn in (1, 2):
        replace_date(batch, table, DAY)
        assert content(spark, table) == sorted(
            [("new", DAY), ("n", NEXT), ("u", "None"), *[("stray", NEXT)] * turn]
        )


def test_empty_batch_clears_the_date_only(spark, table):
    fill(spark, table, raw_row("old"), raw_row("n", f"{NEXT}T00:00:00"), raw_row("u", None))
    replace_date(raw_frame(spark, raw_row("v", None)), table, DAY)
    assert content(spark, table) == [("n", NEXT), ("u", "None"), ("v", "None")]


def test_several_dates_need_the_file_date(spark, table):
    with pytest.raises(ValueError):
        replace_dates(raw_frame(spark, raw_row("1")), table, [DAY, NEXT])


def test_overwrite_mode_of_the_session_is_kept(spark, table):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    replace_date(raw_frame(spark, raw_row("1")), table, DAY)
    assert spark.conf.get(key) == before


def test_range_load_equals_day_by_day(spark, tmp_path):
    """Every stray direction: to an earlier, later and outside date, and undated."""
    from acceptance.warehouse import fresh_database

    span = ["2024-05-01", "2024-05-02", "2024-05-03"]
    every = ["2024-04-30", *span, "2024-05-04"]
    for file_day in span[:2]:
        docs = [record(f"{file_day}>{d}", f"{d}T10:00:00") for d in every]
        land(tmp_path, file_day, 1, [*docs, record(f"{file_day}>none", None)])
    layout = Landing(str(tmp_path))
    outcomes = []
    for loads in ([span], [[d] for d in span]):
        database = fresh_database(spark, "ranges")
        table = f"{database}.raw_events"
        ensure_table(spark, table)
        fill(spark, table, *[raw_row(f"kept{d}", f"{d}T00:00:00") for d in every])
        for dates in loads:
            load_dates(spark, database, layout, dates)
        outcomes.append(content(spark, table))
    assert outcomes[0] == outcomes[1]
    # The third date has no files, so what was there stays.
    assert ("kept2024-05-03", "2024-05-03") in outcomes[0]
    assert ("kept2024-05-02", "2024-05-02") not in outcomes[0]


def test_loading_nothing_changes_nothing(spark, database, tmp_path):
    ensure_table(spark, f"{database}.raw_events")
    fill(spark, f"{database}.raw_events", raw_row("1"))
    result = load_dates(spark, database, Landing(str(tmp_path)), [DAY])
    assert (result.dates, result.rows_loaded, result.source) == ([], 0, None)
    assert spark.table(f"{database}.raw_events").count() == 1


def test_load_reports_rows_per_date(spark, database, tmp_path):
    land(tmp_path, DAY, 0, [record("1", f"{DAY}T00:10:00"), record("2", f"{NEXT}T00:10:00")])
    result = load_dates(spark, database, Landing(str(tmp_path)), [DAY])
    assert result.rows_loaded == 2
    assert result.rows_by_date == {date(2024, 5, 1): 1, date(2024, 5, 2): 1}
    counts = raw_row_counts(spark.table(f"{database}.raw_events")).collect()
    assert {str(r.event_date): r.raw_rows for r in counts} == {DAY: 1, NEXT: 1}


def test_retention(spark, table):
    span = days("2024-05-01", "2024-05-05")
    fill(spark, table, *[raw_row(str(d), f"{d}T00:00:00") for d in span], raw_row("u", None))
    kept = {r.id for r in retained(spark.table(table), "2024-05-05", 2).collect()}
    assert kept == {"2024-05-03", "2024-05-04", "2024-05-05", "u"}
    assert expire_partitions(spark, table, "2024-05-05", 2) == span[:2]
    assert {r.id for r in spark.table(table).collect()} == kept
    assert expire_partitions(spark, table, "2024-05-05", 2) == []


def test_rebuild_drops_stale_dates_and_sorts(spark, database):
    name = f"{database}.t"
    first = spark.range(10).selectExpr("DATE'2024-05-01' AS event_date", "10 - id AS v")
    materialize(first, name, cluster_by=["v"])
    second = first.selectExpr("DATE'2024-05-02' AS event_date", "v")
    stored = materialize(second, name, cluster_by=["v"])
    assert stored_dates(spark, name) == [date(2024, 5, 2)]
    for path in stored.inputFiles():
        values = [r.v for r in spark.read.parquet(path).collect()]
        assert values == sorted(values)


def test_a_large_date_is_written_by_many_tasks(spark, database):
    """One date with nearly all rows must not end up in one task."""
    rows = spark.range(200_000).selectExpr(
        "IF(id % 100 = 0, DATE'2024-05-02', DATE'2024-05-01') AS event_date", "uuid() AS text"
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1MB")
    try:
        stored = materialize(rows, f"{database}.skewed", cluster_by=["text"])
    finally:
        spark.conf.unset(key)
    big = [p for p in stored.inputFiles() if "event_date=2024-05-01" in p]
    assert len(big) > 3
    assert stored.count() == 200_000


def test_date_filter_prunes_partitions(spark, table):
    fill(spark, table, *[raw_row(str(d), f"{d}T00:00:00") for d in days("2024-05-01", "2024-05-05")])
    from tallyhouse.operators.reports import date_range_filter

    rows = date_range_filter(spark.table(table), "2024-05-02", "2024-05-03")
    assert rows.count() == 2
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_day_list():
    assert [str(d) for d in days("2024-02-28", "2024-03-01")] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(ValueError):
        days("2024-03-02", "2024-03-01")
    with pytest.raises(ValueError):
        days("03/02/2024", "2024-03-01")


def test_range_load_takes_files_of_any_name(spark, database, tmp_path):
    landing = Landing(str(tmp_path))
    for n, day in enumerate(("2024-05-01", "2024-05-02")):
        land(tmp_path, day, 0, [record(f"{n}a{i}", f"{day}T10:00:00") for i in range(3)])
        late = tmp_path / day / "hours" / "late.ndjson"
        lines = [json.dumps(record(f"{n}b{i}", f"{day}T11:00:00")) for i in range(5)]
        late.write_text("\n".join([*lines, "{bad"]) + "\n")
    span = ["2024-05-01", "2024-05-02"]
    result = daily.load_dates(spark, database, landing, span)
    assert result.rows_by_date == {as_day: 8 for as_day in days(*span)}
    assert (result.rows_deleted, result.table_rows) == (0, 16)
    single = [daily.load_dates(spark, database, landing, [day]) for day in span]
    assert [(r.rows_loaded, r.rows_deleted, r.table_rows) for r in single] == [(8, 8, 16)] * 2
    with pytest.raises(BadRecordsError):
        daily.load_dates(spark, database, landing, span, bad_record_limit=0)


def test_one_file_per_date(spark, database, tmp_path):
    for day in ("2024-05-01", "2024-05-02"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "events.ndjson").write_text(json.dumps(record(day, f"{day}T01:00:00")) + "\n")
    result = daily.load_dates(spark, database, Landing.daily(str(tmp_path)), ["2024-05-01", "2024-05-02"])
    assert result.rows_loaded == 2


def test_landed_files_expire(spark, tmp_path):
    for day in ("2024-04-30", "2024-05-01", "2024-05-31"):
        land(tmp_path, day, 3, [record("1")])
    gone = expire_landed(spark, Landing(str(tmp_path)), "2024-05-31", 30)
    assert len(gone) == 1 and "2024-04-30" in gone[0]
    assert not (tmp_path / "2024-04-30" / "hours" / "03.ndjson").exists()
    assert (tmp_path / "2024-05-01" / "hours" / "03.ndjson").exists()


def test_rows_of_other_files_are_refused(spark, database):
    ensure_table(spark, f"{database}.raw_events")
    batch = raw_frame(spark, raw_row("1")).withColumn("file_date", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        replace_dates(batch, f"{database}.raw_events", ["2024-05-01"])


def test_failed_rebuild_leaves_the_old_table(spark, database):
    rows = spark.range(3).withColumn("event_date", F.lit("2024-05-01").cast("date"))
    materialize(rows, f"{database}.kept")
    with pytest.raises(Exception):
        materialize(rows.withColumn("id", F.raise_error(F.lit("no")).cast("long")), f"{database}.kept")
    assert spark.table(f"{database}.kept").count() == 3


def test_rebuild_drops_dates_that_no_longer_occur(spark, database):
    rows = spark.createDataFrame(
        [(1, date(2024, 5, 1)), (2, date(2024, 5, 2)), (3, None)], "id long, event_date date"
    )
    materialize(rows, f"{database}.dates")
    stored = materialize(rows.filter("id = 2"), f"{database}.dates")
    assert [tuple(r) for r in stored.collect()] == [(2, date(2024, 5, 2))]
    assert materialize(rows.filter("id > 3"), f"{database}.dates").count() == 0
