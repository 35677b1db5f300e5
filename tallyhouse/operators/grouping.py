"""Grouped counting helpers shared by the marts and usable on their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str | Column]

#: Registers of a distinct sketch, as a power of two: at most 64 KB.
PRECISION = 16


def count_where(column: str, value: object) -> Column:
    """Rows in which ``column`` equals ``value``; NULLs count as no match."""
    return F.count_if(F.col(column) == F.lit(value))


def distinct_counts(df: DataFrame, keys: Keys, columns: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts per group, ``{output: column}``; NULLs are ignored.

    Spark aggregates on (keys, value) first and on the keys second, so one group
    with most of the rows is still spread over the cluster by value.
    """
    return df.groupBy(*keys).agg(
        *[F.count_distinct(F.col(c)).alias(name) for name, c in columns.items()]
    )


def distinct_sketches(
    df: DataFrame, keys: Keys, columns: Mapping[str, str], precision: int = PRECISION
) -> DataFrame:
    """Sketches of the distinct values per group, ``{output: column}``, to store and to merge.

    A sketch has 2^``precision`` registers at most, so a group of any size is a row of bounded
    size, built on the map side first.  NULLs are ignored; a group without values has an empty
    sketch.  Sketches that are to be merged must be of one precision.
    """
    return df.groupBy(*keys).agg(
        *[
            F.hll_sketch_agg(F.col(c), F.lit(precision)).alias(name)
            for name, c in columns.items()
        ]
    )


def merged_distincts(sketches: DataFrame, keys: Keys, columns: Sequence[str]) -> DataFrame:
    """Approximate distinct counts over the union of the stored ``sketches`` of each group.

    The relative standard error is about 0.8 divided by the root of the number of registers: 0.3 %
    at the default precision.  Without rows or keys, the counts are 0.  An opt-in beside
    :func:`distinct_counts`, which is exact.
    """
    return sketches.groupBy(*keys).agg(
        *[
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c)
            for c in columns
        ]
    )


def conditional_counts(
    df: DataFrame, keys: Keys, column: str, values: Mapping[str, object]
) -> DataFrame:
    """Rows per group with ``column`` equal to each value, ``{output: value}``."""
    return df.groupBy(*keys).agg(
        *[count_where(column, v).alias(name) for name, v in values.items()]
    )


def ordinal_grouping(df: DataFrame, keys: Keys, count_name: str = "row_count") -> DataFrame:
    """Rows per combination of the key expressions, NULL being a value of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
