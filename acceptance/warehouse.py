"""Stored copies of the derived records, for queries about files and tables.

Both are written by Spark into the shared folder, once per session and data
folder, and hold every record of :mod:`acceptance.fixture`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.fixture import raw_events
from tallyhouse.plans.daily import (
    build_check_states,
    build_marts,
    build_staging,
    build_uniques,
)
from tallyhouse.session import scratch_path, shared_dir
from tallyhouse.sources.landing import Landing
from tallyhouse.sources.tables import ensure_table


def once_per_session(make: Callable) -> Callable:
    """Remember a result per Spark application, data folder and arguments."""
    made: dict = {}
    lock = Lock()

    @wraps(make)
    def remembered(spark: SparkSession, sf_dir: str, *args):
        key = (spark.sparkContext.applicationId, sf_dir, *args)
        with lock:
            if key not in made:
                made[key] = make(spark, sf_dir, *args)
            return made[key]

    remembered.anew = make
    return remembered


@once_per_session
def day_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last date of the derived records."""
    day = F.to_date("created_at")
    first, last = raw_events(spark, sf_dir).agg(F.min(day), F.max(day)).first()
    return str(first), str(last)


def fresh_database(spark: SparkSession, purpose: str) -> str:
    """A new database whose managed tables lie in the shared folder."""
    name = f"{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/tallyhouse/{name}'")
    return name


def as_lines(raw: DataFrame) -> DataFrame:
    """Raw records as landed NDJSON text with date and hour columns."""

    def text(name: str):
        quoted = F.concat(F.lit('"'), F.col(name), F.lit('"'))
        return F.coalesce(quoted, F.lit("null"))

    def json(name: str):
        return F.coalesce(F.col(name), F.lit("null"))

    stamp = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.concat(
        F.lit('{"id":'), text("id"),
        F.lit(',"type":'), text("type"),
        F.lit(',"actor":'), json("actor"),
        F.lit(',"repo":'), json("repo"),
        F.lit(',"payload":'), json("payload"),
        F.lit(',"public":'), F.col("public").cast("string"),
        F.lit(',"created_at":"'), stamp,
        F.lit('","org":'), json("org"),
        F.lit(',"unused":{"a":1}}'),
    )
    return raw.select(
        line.alias("value"),
        F.to_date("created_at").alias("day"),
        F.date_format("created_at", "HH").alias("hour"),
    )


@once_per_session
def landed_files(spark: SparkSession, sf_dir: str, compression: str) -> Landing:
    """All records as hourly NDJSON files, plain or gzip."""
    root = scratch_path(spark, f"landing-{compression}")
    (
        as_lines(raw_events(spark, sf_dir))
        .hint("rebalance", "day", "hour")
        .write.partitionBy("day", "hour")
        .option("compression", compression)
        .text(root)
    )
    return Landing(root, hour_file="day={date}/hour={hour:02d}", day_files="day={date}")


@once_per_session
def mixed_files(spark: SparkSession, sf_dir: str) -> Landing:
    """All records as files, those of even hours in folders of hours and the others beside them."""
    root = scratch_path(spark, "landing-mixed")
    lines = as_lines(raw_events(spark, sf_dir)).hint("rebalance", "day")
    even = F.col("hour").cast("int") % 2 == 0
    lines.filter(even).write.partitionBy("day", "hour").text(root)
    lines.filter(~even).drop("hour").write.mode("append").partitionBy("day").text(root)
    return Landing(root, hour_file="day={date}/hour={hour:02d}", day_files="day={date}")


def stored_raw(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """A database of its own with every record in its raw table."""
    database = fresh_database(spark, purpose)
    ensure_table(spark, f"{database}.raw_events")
    raw = raw_events(spark, sf_dir).withColumn("event_date", F.to_date("created_at"))
    raw.hint("rebalance", "event_date").write.insertInto(f"{database}.raw_events")
    return database


@once_per_session
def warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A database with staging, marts, member bitmaps and check states built from every record."""
    database = stored_raw(spark, sf_dir, "warehouse")
    build_staging(spark, database)
    build_marts(spark, database)
    build_uniques(spark, database)
    build_check_states(spark, database)
    return database
