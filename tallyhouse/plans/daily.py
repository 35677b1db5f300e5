"""The daily run and its parts, over tables of one database.

Environments (development, staging, production) are different databases with
the same tables, so every function takes the database by name.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import event_date
from tallyhouse.operators import checkstates, uniques
from tallyhouse.operators.idfilter import MAX_BITS
from tallyhouse.operators.marts import MARTS, dated
from tallyhouse.operators.quality import gate, quality_report
from tallyhouse.operators.staging import (
    changed_ids,
    copies_elsewhere,
    restaged,
    staged_from_files,
)
from tallyhouse.schemas import BAD_RECORD_LIMIT, CLUSTERING, RETENTION_DAYS
from tallyhouse.session import drop_path, write_through
from tallyhouse.sources.landing import (
    DateLike,
    Landing,
    as_date,
    days,
    file_listing,
    list_dates,
)
from tallyhouse.sources.ledger import (
    compare_files,
    dates_to_load,
    ensure_ledger,
    file_records,
    note_load,
)
from tallyhouse.sources.ndjson import CORRUPT, LARGE_FILE, BadRecordsError, combine_hours
from tallyhouse.sources.publish import recover
from tallyhouse.sources.tables import (
    DATE,
    ensure_table,
    expire_partitions,
    materialize,
    overwrite_dates,
    raw_row_counts,
    replace_dates,
)

log = logging.getLogger(__name__)

RAW = "raw_events"
STAGING = "stg_events"
#: Landed files that the dates of the raw table were loaded from.
LEDGER = "landed_files"
#: Numbers of actors and repositories, and the bitmaps of those seen on each date.
MEMBERS = "members"
MEMBER_DAYS = "member_days"
#: States of the checks and the ids of staging, by date.
CHECK_STATES = "check_states"
CHECK_IDS = "check_ids"


@dataclass(frozen=True)
class LoadResult:
    """What a load did: the dates it replaced and the rows it stored per date."""

    dates: list[date] = field(default_factory=list)
    source: str | None = None
    rows_by_date: Mapping[date | None, int] = field(default_factory=dict)
    rows_deleted: int = 0
    table_rows: int | None = None

    @property
    def rows_loaded(self) -> int:
        return sum(self.rows_by_date.values())

    @property
    def changed_dates(self) -> list[date]:
        """Dates of the raw table that the load wrote, stray dates included."""
        return sorted({*self.dates, *self.rows_by_date} - {None})


def load_dates(
    spark: SparkSession,
    database: str,
    landing: Landing,
    dates: Sequence[DateLike],
    bad_record_limit: int = BAD_RECORD_LIMIT,
    note_files: bool = False,
) -> LoadResult:
    """Load the landed files of ``dates`` into the raw table, replacing those dates.

    Dates without landed files are left as they are.  The JSON is parsed once,
    into shared scratch; counting malformed records and writing the table then
    read columns.  A date with more malformed records than allowed fails the
    load before the table is touched.  With ``note_files`` the ledger is told which
    files the dates were loaded from (see :func:`load_changed`).
    """
    wanted = sorted({as_date(d) for d in dates})
    ensure_table(spark, f"{database}.{RAW}")
    present = list_dates(spark, landing, wanted)
    if not present:
        log.warning("%s: nothing has landed for %s", database, ", ".join(map(str, wanted)))
        return LoadResult()
    scratch = []
    if note_files:
        # Before the files are read: what changes afterwards is found by the next run.
        listing, path = write_through(file_listing(spark, landing, present), "landed-files")
        scratch.append(path)
    source = "source_file" if note_files else None
    scan = combine_hours(
        spark, landing, present, keep_corrupt=True, large_bytes=LARGE_FILE, file_path=source
    )
    parsed, path = write_through(scan.withColumn(DATE, event_date("created_at")), "parsed-hours")
    scratch.append(path)
    try:
        bad = parsed.filter(F.col(CORRUPT).isNotNull()).groupBy("file_date").count()
        for day, count in bad.collect():
            if count > bad_record_limit:
                raise BadRecordsError(count, bad_record_limit, where=f"files of {day}")
        good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        table = f"{database}.{RAW}"
        recover(spark, table)
        before = {r[0]: r.raw_rows for r in raw_row_counts(spark.table(table)).collect()}
        rows = replace_dates(good, table, present)
        if note_files:
            ledger = f"{database}.{LEDGER}"
            ensure_ledger(spark, ledger)
            note_load(listing, file_records(parsed, source, CORRUPT), ledger, present)
    finally:
        for path in scratch:
            drop_path(spark, path)
    deleted = sum(before.get(day, 0) for day in present)
    total = sum(before.values()) - deleted + sum(rows.values())
    result = LoadResult(present, landing.day_glob(present), rows, deleted, total)
    log.info("%s: loaded %d rows from %s", database, result.rows_loaded, result.source)
    return result


def changed_files(
    spark: SparkSession, database: str, landing: Landing, dates: Sequence[DateLike]
) -> DataFrame:
    """What differs between the landed files of ``dates`` and the ledger, a row per date."""
    ledger = f"{database}.{LEDGER}"
    ensure_ledger(spark, ledger)
    targets = sorted({as_date(d) for d in dates})
    noted = spark.table(ledger).filter(F.col(DATE).isin(*targets))
    return dates_to_load(compare_files(file_listing(spark, landing, targets), noted))


def load_changed(
    spark: SparkSession,
    database: str,
    landing: Landing,
    dates: Sequence[DateLike],
    bad_record_limit: int = BAD_RECORD_LIMIT,
) -> LoadResult:
    """Load those of ``dates`` with files that are new, delivered again or gone since their load.

    A date whose files are as the ledger says is neither read nor written.
    """
    differ = changed_files(spark, database, landing, dates).select(DATE).collect()
    if not differ:
        return LoadResult()
    wanted = [r[DATE] for r in differ]
    return load_dates(spark, database, landing, wanted, bad_record_limit, note_files=True)


def build_staging(spark: SparkSession, database: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Rebuild the staging table from the raw table.

    Records of single ids are written as they lie; only those that won over other
    copies are dealt out by date first.
    """
    with staged_from_files(spark.table(f"{database}.{RAW}"), max_bits) as staged:
        rows = dated(staged.settled)
        if staged.moved is not None:
            rows = rows.unionByName(dated(staged.moved).hint("rebalance", DATE))
        return materialize(
            rows, f"{database}.{STAGING}", cluster_by=CLUSTERING[STAGING], redistribute=False
        )


def build_marts(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Rebuild the four marts from the staging table.

    They do not depend on one another and are submitted together, so the small
    last stages of one overlap with the scans of the next.
    """
    stg = spark.table(f"{database}.{STAGING}")

    def build(name: str) -> DataFrame:
        return materialize(MARTS[name](stg), f"{database}.{name}", cluster_by=CLUSTERING[name])

    with ThreadPoolExecutor(len(MARTS)) as pool:
        tasks = {n: pool.submit(inheritable_thread_target(spark)(build), n) for n in MARTS}
        return {name: task.result() for name, task in tasks.items()}


def build_uniques(
    spark: SparkSession, database: str, changed: Sequence[date] | None = None
) -> DataFrame:
    """Bring the per-date bitmaps of members up to date with the staging table.

    All dates, or those of ``changed`` only; staging is read for these dates.  Numbers
    are only ever added, so bitmaps written before stay right, and a run that failed
    in between can be repeated.
    """
    members, days_table = f"{database}.{MEMBERS}", f"{database}.{MEMBER_DAYS}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {members} (kind STRING, name STRING, number BIGINT) USING parquet")
    stg = spark.table(f"{database}.{STAGING}")
    if changed is not None:
        stg = stg.filter(F.col(DATE).isin(*changed))
    paths: list[str] = []

    def stored(rows: DataFrame, purpose: str) -> DataFrame:
        table, path = write_through(rows, purpose)
        paths.append(path)
        return table

    try:
        seen = stored(uniques.members_by_date(stg), "members-by-date")
        fresh = stored(uniques.new_names(seen, spark.table(members)), "new-members")
        if not fresh.isEmpty():
            shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
            added = uniques.numbered(fresh, spark.table(members), shards)
            stored(added, "numbered-members").write.insertInto(members)
            spark.catalog.refreshTable(members)
        bitmaps = uniques.member_bitmaps(seen, spark.table(members))
        if changed is None or not spark.catalog.tableExists(days_table):
            return materialize(bitmaps, days_table, cluster_by=CLUSTERING[MEMBER_DAYS])
        overwrite_dates(bitmaps, days_table, changed, CLUSTERING[MEMBER_DAYS])
        return spark.table(days_table)
    finally:
        for path in paths:
            drop_path(spark, path)


def stored_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The checked tables as stored."""
    return {name: spark.table(f"{database}.{name}") for name in (STAGING, *MARTS)}


def checks_only(spark: SparkSession, database: str) -> DataFrame:
    """All checks over the stored tables; nothing is rebuilt."""
    return quality_report(stored_tables(spark, database))


def build_check_states(
    spark: SparkSession, database: str, changed: Sequence[date] | None = None
) -> None:
    """Bring the states of all checks up to date, for all dates or for ``changed`` only."""
    tables = stored_tables(spark, database)
    if changed is not None:
        tables = {name: df.filter(F.col(DATE).isin(*changed)) for name, df in tables.items()}
    states = reduce(
        DataFrame.unionByName, [checkstates.date_states(df, name) for name, df in tables.items()]
    )
    for name, rows in ((CHECK_STATES, states), (CHECK_IDS, checkstates.id_words(tables[STAGING]))):
        if changed is None or not _has(spark, database, name):
            materialize(rows, f"{database}.{name}", cluster_by=CLUSTERING[name])
        else:
            overwrite_dates(rows, f"{database}.{name}", changed, CLUSTERING[name])


def checks_from_states(spark: SparkSession, database: str) -> DataFrame:
    """The report of :func:`checks_only` from the states of single dates; no table is read."""
    return checkstates.report_from_states(
        spark.table(f"{database}.{CHECK_STATES}"),
        spark.table(f"{database}.{CHECK_IDS}"),
        (STAGING, *MARTS),
    )


def rebuild(spark: SparkSession, database: str) -> None:
    """Staging and marts from the raw table, stopping at failed staging checks."""
    staging = build_staging(spark, database)
    gate(quality_report({STAGING: staging}))
    gate(quality_report(build_marts(spark, database)))
    build_uniques(spark, database)
    build_check_states(spark, database)


def refresh(spark: SparkSession, database: str, changed: Sequence[DateLike]) -> list[date]:
    """Bring staging and marts up to date after raw rows of ``changed`` were replaced.

    Same tables as :func:`rebuild`, but whole records are read and written for
    the changed dates only, and for other dates that hold copies of their ids.
    Returns the dates rewritten.  Needs tables that were up to date before the
    change; after a failed run, rebuild instead.
    """
    dates = sorted({as_date(d) for d in changed})
    raw, stg = spark.table(f"{database}.{RAW}"), spark.table(f"{database}.{STAGING}")
    ids, ids_path = write_through(changed_ids(raw, stg, dates), "changed-ids")
    paths = [ids_path]
    try:
        moved, path = write_through(copies_elsewhere(raw, ids, dates), "moved-ids")
        paths.append(path)
        others = sorted(r[0] for r in moved.select(DATE).distinct().collect())
        rows, path = write_through(restaged(raw, stg, moved, dates, others), "restaged")
        paths.append(path)
        rewritten = sorted({*dates, *others})
        overwrite_dates(rows, f"{database}.{STAGING}", rewritten, CLUSTERING[STAGING])
    finally:
        for path in paths:
            drop_path(spark, path)
    log.info("%s: rewrote %d dates of staging", database, len(rewritten))
    stg = spark.table(f"{database}.{STAGING}")
    part = stg.filter(F.col(DATE).isin(*rewritten))
    known = _has(spark, database, CHECK_STATES, CHECK_IDS)
    # What a date shows by itself stops the run before the marts; ids repeated over dates
    # show once the states of all dates are put together.
    gate(quality_report({STAGING: part if known else stg}))
    for name, build in MARTS.items():
        overwrite_dates(build(part), f"{database}.{name}", rewritten, CLUSTERING[name])
    build_uniques(spark, database, rewritten if _has(spark, database, MEMBER_DAYS) else None)
    build_check_states(spark, database, rewritten if known else None)
    gate(checks_from_states(spark, database))
    return rewritten


def _has(spark: SparkSession, database: str, *names: str) -> bool:
    return all(spark.catalog.tableExists(f"{database}.{name}") for name in names)


def run_day(
    spark: SparkSession,
    database: str,
    landing: Landing,
    day: DateLike,
    bad_record_limit: int = BAD_RECORD_LIMIT,
    changed_only: bool = False,
) -> LoadResult:
    """Load one date, then rebuild and check everything that follows from it.

    ``changed_only`` refreshes the affected dates instead of whole tables, when
    the tables exist.
    """
    result = load_dates(spark, database, landing, [day], bad_record_limit)
    if result.dates:
        if changed_only and _has(spark, database, STAGING, *MARTS):
            refresh(spark, database, result.changed_dates)
        else:
            rebuild(spark, database)
    return result


def backfill(
    spark: SparkSession,
    database: str,
    landing: Landing,
    date_from: DateLike,
    date_to: DateLike,
    days_per_load: int | None = None,
    bad_record_limit: int = BAD_RECORD_LIMIT,
) -> list[LoadResult]:
    """Load every date of a range and rebuild once at the end.

    The dates are read together; ``days_per_load`` bounds how many, and with it
    the scratch space in use.  The result equals one run per day because staging
    and marts are functions of the whole raw table.
    """
    span = days(date_from, date_to)
    step = days_per_load or len(span)
    results = [
        load_dates(spark, database, landing, span[at : at + step], bad_record_limit)
        for at in range(0, len(span), step)
    ]
    if any(result.dates for result in results):
        rebuild(spark, database)
    return results


def expire(
    spark: SparkSession, database: str, as_of: DateLike, keep_days: int = RETENTION_DAYS
) -> dict[str, list[date]]:
    """Drop dates older than ``keep_days`` before ``as_of`` from every stored table."""
    return {
        name: expire_partitions(spark, f"{database}.{name}", as_of, keep_days)
        for name in (RAW, STAGING, *MARTS, MEMBER_DAYS, CHECK_STATES, CHECK_IDS)
        if _has(spark, database, name)
    }
