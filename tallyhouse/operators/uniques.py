"""Exact distinct actors and repositories of any date range, from one bitmap per date.

Every name gets a number, dense from 1 and never changed.  A date's members are then a bitmap over
the numbers, in buckets of 32,768; the members of a range are the union of its dates' bitmaps and
their count is the number of bits set.  Staged rows are read once, when a date is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.marts import dated
from tallyhouse.operators.reports import date_range_filter, kpi_totals
from tallyhouse.sources.landing import DateLike

#: What is counted: kind of member -> staging column.
KINDS = {"actor": "actor_login", "repo": "repo_name"}

#: Output columns of a range, by kind.
_FIGURES = {"actor": "unique_actors", "repo": "unique_repos"}


def members_by_date(stg: DataFrame) -> DataFrame:
    """(event_date, kind, name), each once; rows without a value do not count."""
    entries = [F.struct(F.lit(kind).alias("kind"), F.col(c).alias("name")) for kind, c in KINDS.items()]
    listed = dated(stg).select("event_date", F.inline(F.array(*entries)))
    return listed.filter(F.col("name").isNotNull()).distinct()


def new_names(seen: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, name) of ``seen`` that the numbered members ``known`` lack."""
    return seen.select("kind", "name").distinct().join(known, ["kind", "name"], "left_anti")


def numbered(fresh: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """(kind, name, number) of the stored names ``fresh``, going on from those of ``known``.

    Names are dealt into ``shards`` by their hash; a shard numbers its names on from the sizes of
    the shards before it.  The only list that is seen whole has a row per shard, and the numbers
    depend on the names alone, not on partitions or retries.
    """
    dealt = fresh.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    last = known.groupBy("kind").agg(F.max("number").alias("last"))
    earlier = Window.partitionBy("kind").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("kind", "shard").agg(F.count(F.lit(1)).alias("size"))
    starts = (
        sizes.join(F.broadcast(last), "kind", "left")
        .withColumn(
            "start", F.coalesce("last", F.lit(0)) + F.coalesce(F.sum("size").over(earlier), F.lit(0))
        )
        .select("kind", "shard", "start")
    )
    place = F.row_number().over(Window.partitionBy("kind", "shard").orderBy("name"))
    return (
        dealt.withColumn("place", place)
        .join(F.broadcast(starts), ["kind", "shard"])
        .select("kind", "name", (F.col("start") + F.col("place")).cast("long").alias("number"))
    )


def member_bitmaps(seen: DataFrame, members: DataFrame) -> DataFrame:
    """(event_date, kind, bucket, bits) of the dated names ``seen``."""
    numbers = seen.join(members, ["kind", "name"]).select("event_date", "kind", "number")
    return numbers.groupBy(
        "event_date", "kind", F.bitmap_bucket_number("number").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def range_uniques(bitmaps: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Distinct members over a date range as one row, 0 when there are none."""
    merged = (
        date_range_filter(bitmaps, start, end)
        .groupBy("kind", "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    size = F.bitmap_count("bits")
    return merged.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == kind, size)), F.lit(0)).cast("long").alias(name)
            for kind, name in _FIGURES.items()
        ]
    )


def range_kpis(by_type: DataFrame, bitmaps: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Totals and distinct counts of a range as one row, from small tables only."""
    parts = kpi_totals(by_type, start, end).unionByName(
        range_uniques(bitmaps, start, end), allowMissingColumns=True
    )
    names = ("total_events", "event_types", *_FIGURES.values())
    return parts.agg(*[F.max(name).alias(name) for name in names])
