"""Stored tables: Parquet, partitioned by date."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta
from functools import reduce
from operator import or_
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import event_date
from tallyhouse.schemas import RAW_SCHEMA, RETENTION_DAYS
from tallyhouse.sources.landing import DateLike, as_date
from tallyhouse.sources.publish import DATE, Load, partition_spec, publish, stored_dates

_RAW_NAMES = RAW_SCHEMA.fieldNames()


def ensure_table(spark: SparkSession, table: str) -> None:
    """Create the raw table, partitioned by date; an existing one is left alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {DATE} DATE) "
        f"USING parquet PARTITIONED BY ({DATE})"
    )


def _clear(spark: SparkSession, table: str, day: date) -> None:
    # A static-partition overwrite with no rows: other dates are not touched,
    # and it works for managed and external tables alike.
    values = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in spark.table(table).schema.fields
        if f.name != DATE
    )
    target = f"{table} PARTITION ({DATE} = DATE'{day}')"
    spark.sql(f"INSERT OVERWRITE TABLE {target} SELECT {values} WHERE false")


def delete_date(spark: SparkSession, table: str, day: DateLike) -> int:
    """Delete one date's rows and return how many there were.

    Rows of other dates and rows without a date stay.
    """
    target = as_date(day)
    found = spark.table(table).filter(F.col(DATE) == F.lit(target)).count()
    if found:
        _clear(spark, table, target)
    return found


class _Mode:
    """The overwrite mode a session had, and how many writes want the dynamic one now."""

    def __init__(self) -> None:
        self.before: str | None = None
        self.writes = 0


_MODE_LOCK = Lock()
_MODES: WeakKeyDictionary[SparkSession, _Mode] = WeakKeyDictionary()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    # insertInto takes the mode from the session only; a writer option of the
    # same name is ignored there.  Writes on several threads share the setting:
    # the first one makes it, the last one restores it, none waits for another.
    key = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        mode = _MODES.setdefault(spark, _Mode())
        if not mode.writes:
            mode.before = spark.conf.get(key)
            spark.conf.set(key, "dynamic")
        mode.writes += 1
    try:
        yield
    finally:
        with _MODE_LOCK:
            mode.writes -= 1
            if not mode.writes:
                spark.conf.set(key, mode.before)


def replace_dates(
    batch: DataFrame, table: str, dates: Sequence[DateLike]
) -> dict[date | None, int]:
    """Load ``batch`` as if each of ``dates`` had been loaded in turn.

    Loading a date deletes its rows and then appends the date's whole file set,
    stray rows of other dates included.  Over several dates in ascending order
    that comes to this, which is done in one pass:

    * rows of a loaded date survive unless that date was loaded after the file
      they came from (``file_date`` column; without it there must be one date);
    * stray rows of dates outside ``dates`` (or without a date) are appended;
    * a loaded date without rows ends up empty.

    The dates are replaced in two phases (see :mod:`tallyhouse.sources.publish`): a
    load that fails leaves the old rows or is finished by the next load.  Returns
    the rows loaded per date.

    ``batch`` is read more than once: pass a stored scan, not a parse of JSON.
    A stored ``event_date`` column lets the stray pass skip what it does not need.
    """
    spark = batch.sparkSession
    targets = sorted({as_date(d) for d in dates})
    if not targets:
        raise ValueError("no dates to load")
    if "file_date" not in batch.columns:
        if len(targets) > 1:
            raise ValueError("several dates need a file_date column")
        batch = batch.withColumn("file_date", F.lit(targets[0]))
    if DATE not in batch.columns:
        batch = batch.withColumn(DATE, event_date("created_at"))

    day, file_day = F.col(DATE), F.col("file_date")
    loaded = day.isin(*targets) & (day <= file_day)
    stray = day.isNull() | ~day.isin(*targets)
    known = F.coalesce(file_day.isin(*targets), F.lit(False))
    seen = (
        batch.filter(loaded | stray | ~known)
        .groupBy(DATE)
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("foreign"))
        .collect()
    )
    if any(r.foreign for r in seen):
        raise ValueError("rows whose file_date is missing or not among the dates to load")
    counts = {r[DATE]: r.rows for r in seen}
    columns = [*_RAW_NAMES, DATE]

    parts = []
    if any(d in counts for d in targets):
        parts.append(batch.filter(loaded).select(*columns))
    elsewhere = [d for d in counts if d not in targets]
    if elsewhere:
        # A date is replaced whole, so what it has goes along with the stray rows.
        there = reduce(or_, [day.eqNullSafe(F.lit(d).cast("date")) for d in elsewhere])
        kept = spark.table(table).filter(there).select(*columns)
        strays = batch.filter(stray).select(*columns).unionByName(kept)
        parts.append(strays.hint("rebalance", DATE))
    publish(spark, table, parts, counts, [d for d in targets if d not in counts])
    return counts


def replace_date(batch: DataFrame, table: str, day: DateLike) -> dict[date | None, int]:
    """Delete one date, then append the whole load; safe to run again."""
    return replace_dates(batch, table, [day])


def raw_row_counts(raw: DataFrame) -> DataFrame:
    """Rows per date; NULL dates are counted as a group."""
    day = DATE if DATE in raw.columns else event_date("created_at").alias(DATE)
    return raw.groupBy(day).agg(F.count(F.lit(1)).alias("raw_rows"))


def materialize(
    df: DataFrame,
    table: str,
    cluster_by: Sequence[str] = (),
    redistribute: bool = True,
) -> DataFrame:
    """Rebuild a table from ``df`` and return it as stored.

    Files are partitioned by date and sorted by the clustering columns, so date
    filters skip directories and other filters skip row groups and pages.  The
    rows are spread by a rebalance, which packs small dates together and splits
    a large date over as many tasks as its size needs.  With ``redistribute``
    off the rows are written where they are, for inputs that already lie by date.

    The whole table is replaced, dates that no longer occur included.  The new
    files of a stored table are committed together once all are written, so it
    stays as it is when the write fails; then the dates that have old files only
    are dropped.  A table of other columns is dropped before it is written.
    """
    spark = df.sparkSession
    placed = df.hint("rebalance", DATE) if redistribute else df
    placed = placed.sortWithinPartitions(DATE, *cluster_by)
    names = [*[c for c in df.columns if c != DATE], DATE]
    types = dict(df.dtypes)
    if not (
        spark.catalog.tableExists(table)
        and spark.table(table).dtypes == [(name, types[name]) for name in names]
    ):
        placed.write.mode("overwrite").format("parquet").partitionBy(DATE).saveAsTable(table)
        return spark.table(table)
    before = set(stored_dates(spark, table))
    noted, seen = _dates_seen(placed.select(*names))
    with _dynamic_overwrite(spark):
        noted.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    _drop_dates(spark, table, before - seen())
    return spark.table(table)


def _drop_dates(spark: SparkSession, table: str, dates: Collection[date | None]) -> None:
    if dates:
        listed = ", ".join(partition_spec(d) for d in dates)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
        spark.catalog.refreshTable(table)


def _dates_seen(df: DataFrame) -> tuple[DataFrame, Callable[[], set[date | None]]]:
    """``df`` and, once it is written, the dates its rows had."""
    seen = Observation()
    noted = df.observe(
        seen,
        F.collect_set(F.col(DATE).cast("string")).alias("dates"),
        F.count_if(F.col(DATE).isNull()).alias("undated"),
    )

    def dates() -> set[date | None]:
        found = {date.fromisoformat(d) for d in seen.get["dates"]}
        return found | {None} if seen.get["undated"] else found

    return noted, dates


def overwrite_dates(
    df: DataFrame, table: str, dates: Sequence[DateLike], cluster_by: Sequence[str] = ()
) -> None:
    """Replace ``dates`` of a stored table with the rows of ``df`` dated so.

    Other dates are not touched; a date without rows goes.  ``df`` is worked out
    once and may read the dates it replaces.  The dates change in two phases, as in
    a load, so a refresh that fails can be repeated.
    """
    spark = df.sparkSession
    targets = sorted({as_date(d) for d in dates})
    rows = df.filter(F.col(DATE).isin(*targets)).select(*spark.table(table).columns)
    noted, seen = _dates_seen(rows.hint("rebalance", DATE).sortWithinPartitions(DATE, *cluster_by))
    load = Load.begin(spark, table)
    load.write(noted)
    filled = seen()
    load.commit(sorted(filled), [d for d in targets if d not in filled])
    load.adopt()
    load.clean()


def retained(df: DataFrame, as_of: DateLike, keep_days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than ``keep_days`` before ``as_of``; undated rows stay."""
    oldest = as_date(as_of) - timedelta(keep_days)
    return df.filter(F.col(DATE).isNull() | (F.col(DATE) >= F.lit(oldest)))


def expire_partitions(
    spark: SparkSession, table: str, as_of: DateLike, keep_days: int = RETENTION_DAYS
) -> list[date]:
    """Drop partitions older than ``keep_days`` before ``as_of``; returns them.

    A catalog operation: no data is read or rewritten.
    """
    oldest = as_date(as_of) - timedelta(keep_days)
    expired = sorted(d for d in stored_dates(spark, table) if d is not None and d < oldest)
    _drop_dates(spark, table, expired)
    return expired
