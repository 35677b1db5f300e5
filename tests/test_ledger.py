"""Landed files against the ledger, and loads of what differs only."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import land, record
from tallyhouse.plans import daily
from tallyhouse.sources.landing import Landing, file_listing
from tallyhouse.sources.ndjson import BadRecordsError

DAY, NEXT, THIRD = "2024-05-01", "2024-05-02", "2024-05-03"
DATES = [DAY, NEXT, THIRD]


def ids(spark, database):
    return sorted(r.id for r in spark.table(f"{database}.raw_events").collect())


def differing(spark, database, layout):
    rows = daily.changed_files(spark, database, layout, DATES).collect()
    return {str(r.event_date): (r.new, r.changed, r.gone) for r in rows}


@pytest.fixture()
def layout(tmp_path):
    for n, day in enumerate([DAY, NEXT]):
        land(tmp_path, day, 0, [record(f"{n}a", f"{day}T00:00:00")])
        land(tmp_path, day, 7, [record(f"{n}b", f"{day}T07:00:00")], suffix="ndjson.gz")
    return Landing(str(tmp_path))


def test_listing_reads_names_and_sizes(spark, layout, tmp_path):
    (tmp_path / DAY / "hours" / "notes.ndjson").write_text("\n")
    (tmp_path / DAY / "hours" / "09.ndjson").write_text("")
    rows = file_listing(spark, layout, DATES).collect()
    found = {(str(r.event_date), r.hour_of_day) for r in rows}
    assert found == {(DAY, 0), (DAY, 7), (DAY, None), (NEXT, 0), (NEXT, 7)}
    sizes = {p.name: p.stat().st_size for p in (tmp_path / DAY / "hours").iterdir()}
    assert sizes.pop("09.ndjson") == 0
    listed = {r.path.rsplit("/", 1)[1]: r.length for r in rows if str(r.event_date) == DAY}
    assert listed == sizes
    assert file_listing(spark, layout, [THIRD]).count() == 0


def test_only_what_differs_is_loaded(spark, database, layout, tmp_path):
    assert differing(spark, database, layout) == {DAY: (2, 0, 0), NEXT: (2, 0, 0)}
    first = daily.load_changed(spark, database, layout, DATES)
    assert first.dates == [date(2024, 5, 1), date(2024, 5, 2)]
    assert ids(spark, database) == ["0a", "0b", "1a", "1b"]
    assert daily.load_changed(spark, database, layout, DATES).dates == []

    # A file that comes late, and one that is delivered again under its name.
    land(tmp_path, NEXT, 8, [record("1c", f"{NEXT}T08:00:00")])
    land(tmp_path, THIRD, 1, [record("2a", f"{THIRD}T01:00:00")])
    assert differing(spark, database, layout) == {NEXT: (1, 0, 0), THIRD: (1, 0, 0)}
    second = daily.load_changed(spark, database, layout, DATES)
    assert second.dates == [date(2024, 5, 2), date(2024, 5, 3)]
    assert ids(spark, database) == ["0a", "0b", "1a", "1b", "1c", "2a"]

    land(tmp_path, DAY, 0, [record("0z", f"{DAY}T00:00:00"), record("0y", f"{DAY}T00:00:00")])
    assert differing(spark, database, layout) == {DAY: (0, 1, 0)}
    daily.load_changed(spark, database, layout, DATES)
    assert ids(spark, database) == ["0b", "0y", "0z", "1a", "1b", "1c", "2a"]


def test_same_length_at_another_time_is_a_change(spark, database, layout, tmp_path):
    daily.load_changed(spark, database, layout, DATES)
    path = tmp_path / DAY / "hours" / "00.ndjson"
    path.write_text(path.read_text().replace("0a", "0q"))
    os.utime(path, (1, 1))
    assert differing(spark, database, layout) == {DAY: (0, 1, 0)}
    daily.load_changed(spark, database, layout, DATES)
    assert ids(spark, database) == ["0b", "0q", "1a", "1b"]


def test_files_that_are_gone(spark, database, layout, tmp_path):
    daily.load_changed(spark, database, layout, DATES)
    (tmp_path / DAY / "hours" / "00.ndjson").unlink()
    for hour in (tmp_path / NEXT / "hours").iterdir():
        hour.unlink()
    # All files of the second date have expired: what was loaded from them stays.
    assert differing(spark, database, layout) == {DAY: (0, 0, 1)}
    daily.load_changed(spark, database, layout, DATES)
    assert ids(spark, database) == ["0b", "1a", "1b"]
    assert differing(spark, database, layout) == {}


def test_ledger_counts_records_of_files(spark, database, layout, tmp_path):
    land(tmp_path, DAY, 9, [record("0d", f"{DAY}T09:00:00")], extra_lines=["{oops", "", "{oops"])
    land(tmp_path, DAY, 10, [], extra_lines=[""])
    daily.load_changed(spark, database, layout, DATES)
    noted = spark.table(f"{database}.landed_files").filter(F.col("event_date") == DAY)
    found = {r.hour_of_day: (r.records, r.malformed) for r in noted.collect()}
    assert found == {0: (1, 0), 7: (1, 0), 9: (1, 2), 10: (0, 0)}


def test_a_failed_load_is_found_again(spark, database, layout, tmp_path, monkeypatch):
    def failing(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(daily, "note_load", failing)
    with pytest.raises(RuntimeError):
        daily.load_changed(spark, database, layout, DATES)
    monkeypatch.undo()
    assert differing(spark, database, layout) == {DAY: (2, 0, 0), NEXT: (2, 0, 0)}
    daily.load_changed(spark, database, layout, DATES)
    assert ids(spark, database) == ["0a", "0b", "1a", "1b"]

    land(tmp_path, DAY, 5, [], extra_lines=["{oops"] * 3)
    with pytest.raises(BadRecordsError):
        daily.load_changed(spark, database, layout, DATES, bad_record_limit=2)
    assert differing(spark, database, layout) == {DAY: (1, 0, 0)}


def test_plain_loads_keep_no_ledger(spark, database, layout):
    daily.load_dates(spark, database, layout, [DAY])
    assert not spark.catalog.tableExists(f"{database}.landed_files")
    assert differing(spark, database, layout)[DAY] == (2, 0, 0)


@pytest.mark.parametrize(
    "layout",
    [Landing("s3://lake/a%b"), Landing.archive("/x/"), Landing("/y", hour_file="d={date}/h={hour:03d}")],
)
def test_path_columns_are_the_paths(spark, layout):
    asked = [(date(2024, 5, 1), 0), (date(2024, 12, 31), 23)]
    frame = spark.createDataFrame([*asked, (None, 3)], "day date, hour int")
    found = frame.select(
        layout.hour_path_of(F.col("day"), F.col("hour")), layout.daily_path_of(F.col("day"))
    ).collect()
    expected = [(layout.hour_path(d, h), layout.daily_path(d)) for d, h in asked]
    assert [tuple(r) for r in found] == [*expected, (None, None)]
