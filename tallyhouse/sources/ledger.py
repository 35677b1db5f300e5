"""The ledger of a raw table: which landed files its dates were loaded from.

A load notes path, length, time and records of every file it took.  A listing of what lies
there now, held against the ledger, tells which dates have files that are new, that were
delivered again, or that are gone, so a run loads these and no others.

The listing is taken before the files are read and the ledger is written after the table.
A file that changes meanwhile, or a load that fails between the two, shows as a difference,
and the date is loaded once more; loading a date again is harmless, missing a file is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.landing import DateLike, as_date
from tallyhouse.sources.publish import DATE
from tallyhouse.sources.tables import overwrite_dates

#: States of a file, in the order they are looked for.
NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"

_COLUMNS = ["path", "length", "modified", "hour_of_day", "records", "malformed", "loaded_at", DATE]


def ensure_ledger(spark: SparkSession, table: str) -> None:
    """Create the ledger, partitioned by date; an existing one is left alone."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (path STRING, length BIGINT, modified TIMESTAMP, "
        f"hour_of_day INT, records BIGINT, malformed BIGINT, loaded_at TIMESTAMP, {DATE} DATE) "
        f"USING parquet PARTITIONED BY ({DATE})"
    )


def file_records(parsed: DataFrame, path: str, malformed: str) -> DataFrame:
    """Good and malformed records per file of a stored parse; combined before the shuffle."""
    return parsed.groupBy(F.col(path).alias("path")).agg(
        F.count_if(F.col(malformed).isNull()).alias("records"),
        F.count(malformed).alias("malformed"),
    )


def note_load(
    listing: DataFrame, records: DataFrame, ledger: str, dates: Sequence[DateLike]
) -> None:
    """Replace what the ledger says of ``dates`` by the files of ``listing``.

    ``listing`` is stored and was taken before the load; a file without records, one with
    blank lines only, is noted with none.
    """
    targets = [as_date(d) for d in dates]
    files = listing.filter(F.col(DATE).isin(*targets))
    noted = files.join(records, "path", "left").select(
        "path", "length", "modified", "hour_of_day",
        F.coalesce("records", F.lit(0)).cast("long").alias("records"),
        F.coalesce("malformed", F.lit(0)).cast("long").alias("malformed"),
        F.current_timestamp().alias("loaded_at"),
        DATE,
    )
    overwrite_dates(noted.select(*_COLUMNS), ledger, targets, cluster_by=["path"])


def compare_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """(event_date, hour_of_day, path, state) of every file of either side.

    A file of another length or time is ``changed``.  One that the listing has no longer is
    ``gone``: pass the ledger's rows of the dates listed only.
    """
    now = listing.select("path", "length", "modified", DATE, "hour_of_day")
    then = ledger.select(
        "path",
        F.col("length").alias("old_length"),
        F.col("modified").alias("old_modified"),
        F.col(DATE).alias("old_date"),
        F.col("hour_of_day").alias("old_hour"),
    )
    differs = (F.col("length") != F.col("old_length")) | (
        F.col("modified") != F.col("old_modified")
    )
    state = (
        F.when(F.col("old_length").isNull(), NEW)
        .when(F.col("length").isNull(), GONE)
        .when(differs, CHANGED)
        .otherwise(SAME)
    )
    return now.join(then, "path", "full").select(
        F.coalesce(DATE, "old_date").alias(DATE),
        F.coalesce("hour_of_day", "old_hour").alias("hour_of_day"),
        "path",
        state.alias("state"),
    )


def dates_to_load(compared: DataFrame) -> DataFrame:
    """(event_date, new, changed, gone) of the dates whose files differ from the ledger.

    A date all of whose files are gone is not among them: files expire, and what was loaded
    from them stays.
    """

    def files(state: str) -> Column:
        return F.count_if(F.col("state") == state).alias(state)

    present = F.count_if(F.col("state") != GONE)
    counted = compared.groupBy(DATE).agg(
        files(NEW), files(CHANGED), files(GONE), present.alias("present")
    )
    return counted.filter("present > 0 AND new + changed + gone > 0").drop("present")
