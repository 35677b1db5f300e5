"""Raw records to one clean row per event."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import event_date, json_texts
from tallyhouse.operators.idfilter import MAX_BITS, IdFilter, id_filter
from tallyhouse.schemas import REQUIRED_FIELDS, STAGING_COLUMNS
from tallyhouse.session import drop_path, write_through


def required_fields(raw: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Keep records that have every one of ``fields``.

    Written as one null test per field, the form Parquet scans can push down.
    """
    return raw.filter(reduce(and_, [F.col(name).isNotNull() for name in fields]))


def _narrow_columns() -> list[Column]:
    """Every staging column but the payload, from raw columns."""
    return [
        F.col("id").alias("event_id"),
        F.col("created_at").cast("timestamp").alias("event_timestamp"),
        F.col("type").alias("event_type"),
        *json_texts("repo", repo_name="name", repo_id="id"),
        *json_texts("actor", actor_login="login", actor_id="id"),
        *json_texts("org", org_login="login"),
        F.col("public").cast("boolean").alias("is_public"),
    ]


def project_rename(raw: DataFrame, payload: bool = True) -> DataFrame:
    """Raw columns under their staging names, JSON scalars pulled out as text.

    Extraction happens here, before any shuffle, so the shuffle moves the few
    short strings and not the JSON documents.
    """
    return raw.select(*_narrow_columns(), *(["payload"] if payload else []))


def dedup_latest(
    df: DataFrame,
    key: str | Sequence[str],
    newest: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one with the largest ``newest``, then ``tie_break``.

    Ranked with ``row_number() = 1``, which Spark plans as a group limit before
    and after the shuffle: each map task sends at most one row per key, so a key
    that owns a third of the table costs one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(name).desc() for name in (newest, *tie_break)]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter("_rank = 1").drop("_rank")


#: Order among copies with one timestamp.  The payload comes last, so leaving it
#: out never changes which of the other values win.
_TIE_BREAK = tuple(c for c in STAGING_COLUMNS if c not in ("event_id", "event_timestamp"))


def stage_events(raw: DataFrame, payload: bool = True) -> DataFrame:
    """Required fields, projection and deduplication in one plan.

    Without ``payload`` the large JSON column is neither read nor shuffled; the
    other columns are the same either way.
    """
    staged = project_rename(required_fields(raw), payload=payload)
    tie_break = [c for c in _TIE_BREAK if c in staged.columns]
    kept = dedup_latest(staged, "event_id", "event_timestamp", tie_break)
    return kept.select(*[c for c in STAGING_COLUMNS if c in kept.columns])


# ---------------------------------------------------------------------------
# Deduplication of a stored table without moving the records of single ids
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class StoredStaging:
    """Staged rows in two parts.

    ``settled`` rows have an id of their own.  They were never shuffled: each task
    holds rows of the dates of the files it read, so they can be written by date as
    they lie.  ``moved`` rows won over other copies and lie by id; there are none
    when no id comes twice.
    """

    settled: DataFrame
    moved: DataFrame | None

    @property
    def rows(self) -> DataFrame:
        return self.settled if self.moved is None else self.settled.unionByName(self.moved)


def repeated_ids(raw: DataFrame) -> DataFrame:
    """Ids that usable records carry more than once.

    Reads the required fields only and combines counts before the shuffle.
    """
    return (
        required_fields(raw)
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("id")
    )


@contextmanager
def staged_from_files(raw: DataFrame, max_bits: int = MAX_BITS) -> Iterator[StoredStaging]:
    """Staged rows of a stored raw table, for the duration of the ``with`` block.

    The repeated ids are found from the id column and put into a filter of at most
    ``max_bits`` bits, which is broadcast.  Records that it rules out have an id of
    their own and pass as they lie.  Only the rest is shuffled and ranked as in
    :func:`stage_events`: copies, and the few single records that the filter hits
    by chance.  A hot id is one row per map task there.

    There is one plan for every number of repeated ids.  Beyond what the filter
    holds, more single records take the way of the copies.
    """
    spark = raw.sparkSession
    scratch: list[str] = []

    def stored(rows: DataFrame, purpose: str) -> DataFrame:
        table, path = write_through(rows, purpose)
        scratch.append(path)
        return table

    try:
        ids = stored(repeated_ids(raw), "repeated-ids")
        usable, n = required_fields(raw), ids.count()
        if n == 0:
            yield StoredStaging(project_rename(usable), None)
            return
        made = id_filter(ids, n, max_bits=max_bits)
        filter_ = IdFilter(stored(made.blocks, "repeated-id-bits"), made.bits)
        copies, single = filter_.split(usable, "id")
        yield StoredStaging(project_rename(single), stage_events(copies))
    finally:
        for path in scratch:
            drop_path(spark, path)


# ---------------------------------------------------------------------------
# Staging of changed dates only
# ---------------------------------------------------------------------------


def changed_ids(raw: DataFrame, stg: DataFrame, changed: Sequence[date]) -> DataFrame:
    """Distinct ids on the dates ``changed``, now or before.

    ``raw`` holds the new records and ``stg`` the staging table from before, both
    with ``event_date``; only those dates are read.
    """
    inside = F.col("event_date").isin(*changed)
    now = required_fields(raw.filter(inside)).select("id")
    before = stg.filter(inside).select(F.col("event_id").alias("id"))
    return now.unionAll(before).distinct()


def copies_elsewhere(raw: DataFrame, ids: DataFrame, changed: Sequence[date]) -> DataFrame:
    """(id, event_date) of usable records of other dates that carry one of ``ids``.

    Only through these can another date gain or lose a staged row.  ``ids`` is the
    stored result of :func:`changed_ids`.  A filter of them is broadcast, so the
    history's ids are read once and nothing but the filter's hits is moved.
    """
    history = required_fields(raw.filter(~F.col("event_date").isin(*changed)))
    hits = id_filter(ids, ids.count()).maybe(history.select("id", "event_date"), "id")
    return hits.join(ids, "id", "left_semi").distinct()


def restaged(
    raw: DataFrame,
    stg: DataFrame,
    moved: DataFrame,
    changed: Sequence[date],
    others: Sequence[date],
) -> DataFrame:
    """New staging rows of the dates ``changed`` and ``others``, with ``event_date``.

    ``moved`` is the stored result of :func:`copies_elsewhere` and ``others`` its
    dates.  Every copy of an id seen on a changed date lies on one
    of the two, so these ids are deduplicated within them; the other staged rows
    of ``others`` stay as they are.
    """
    day = F.col("event_date")
    elsewhere = raw.filter(day.isin(*others)).join(moved, "id", "left_semi")
    fresh = stage_events(raw.filter(day.isin(*changed)).unionByName(elsewhere))
    stay = stg.filter(day.isin(*others)).join(moved, stg["event_id"] == moved["id"], "left_anti")
    columns = [*STAGING_COLUMNS, "event_date"]
    dated = fresh.withColumn("event_date", event_date("event_timestamp"))
    return dated.select(*columns).unionByName(stay.select(*columns))
