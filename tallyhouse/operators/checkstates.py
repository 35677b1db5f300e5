"""Checks of whole tables from states of single dates.

Counts of violations add up over dates.  Distinct values do not, so a date keeps the few event
types it has, and its ids as a bitmap: an id in digits is bit ``id % 64`` of word ``id / 64``, any
other id is kept as it is.  Words of all dates together tell how many ids there are, and with the
number of rows how many are repeated, within a date or over dates.  A change of some dates is
then checked by reading those dates and the states of the others, never their rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.marts import dated
from tallyhouse.operators.quality import TABLE_CHECKS, Check

#: Checked for repeats: table and column.
ID_TABLE, ID_COLUMN = "stg_events", "event_id"

_WORD_BITS = 64


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "\\'") + "'"


def date_states(df: DataFrame, table: str) -> DataFrame:
    """(event_date, table_name, column_name, check_name, total, seen) of each date, in one pass."""
    rules = TABLE_CHECKS[table]
    source = dated(df) if table == ID_TABLE else df
    measures = []
    for i, rule in enumerate(rules):
        measures.append(F.expr(f"CAST({rule.partial or rule.failures} AS BIGINT)").alias(f"t{i}"))
        if rule.members:
            measures.append(F.collect_set(rule.members).alias(f"m{i}"))
    entries = [
        f"struct({_text(table)} AS table_name, {_text(rule.column)} AS column_name, "
        f"{_text(rule.name)} AS check_name, t{i} AS total, "
        f"{f'm{i}' if rule.members else 'CAST(NULL AS ARRAY<STRING>)'} AS seen)"
        for i, rule in enumerate(rules)
    ]
    measured = source.groupBy("event_date").agg(*measures)
    return measured.selectExpr("event_date", f"inline(array({', '.join(entries)}))")


def id_words(stg: DataFrame, column: str = ID_COLUMN) -> DataFrame:
    """(event_date, word, bits, other): the ids of each date, 64 neighbouring numbers to a row.

    ``other`` is an id that is not a number in its usual digits, with ``word`` NULL.
    """
    number = F.when(F.col(column).rlike("^(0|[1-9][0-9]{0,17})$"), F.col(column)).cast("long")
    ids = dated(stg).filter(F.col(column).isNotNull()).select("event_date", number.alias("n"), column)
    return ids.groupBy(
        "event_date",
        F.floor(F.col("n") / _WORD_BITS).alias("word"),
        F.when(F.col("n").isNull(), F.col(column)).alias("other"),
    ).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(n % {_WORD_BITS} AS INT))")).alias("bits")).select(
        "event_date", "word", "bits", "other"
    )


def distinct_ids(words: DataFrame) -> DataFrame:
    """One row: the number of ids over all dates of ``words``."""
    merged = words.groupBy("word", "other").agg(F.bit_or("bits").alias("bits"))
    each = F.when(F.col("word").isNull(), F.lit(1)).otherwise(F.bit_count("bits"))
    return merged.agg(F.coalesce(F.sum(each), F.lit(0)).cast("long").alias("ids"))


def _declared(states: DataFrame, tables: Iterable[str]) -> DataFrame:
    """The checks of ``tables`` with the SQL that decides them, a row each."""
    rules: list[tuple[str, Check]] = [(t, rule) for t in tables for rule in TABLE_CHECKS[t]]
    rows = ", ".join(
        f"struct({n} AS place, {_text(t)} AS table_name, {_text(rule.column)} AS column_name, "
        f"{_text(rule.name)} AS check_name)"
        for n, (t, rule) in enumerate(rules)
    )
    return states.sparkSession.range(1).selectExpr(f"inline(array({rows}))")


def report_from_states(states: DataFrame, words: DataFrame, tables: Iterable[str]) -> DataFrame:
    """The report of :func:`quality_report` over all dates, from stored states."""
    names = list(tables)
    keys = ["table_name", "column_name", "check_name"]
    parts = states.filter(F.col("table_name").isin(*names)).select(*keys, "total", "seen")
    if ID_TABLE in names:
        # Rows with an id less the ids there are: as many are one too many.
        fewer = distinct_ids(words).select(
            F.lit(ID_TABLE).alias("table_name"), F.lit(ID_COLUMN).alias("column_name"),
            F.lit("unique").alias("check_name"), (-F.col("ids")).alias("total"),
            F.lit(None).cast("array<string>").alias("seen"),
        )
        parts = parts.unionByName(fewer)
    merged = parts.groupBy(*keys).agg(
        F.sum("total").alias("total"),
        F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"),
    )
    declared = _declared(states, names)
    same = [declared[k].eqNullSafe(merged[k]) for k in keys]
    met = declared.join(merged, same, "left").select(
        "place", *[declared[k] for k in keys],
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("seen", F.array().cast("array<string>")).alias("seen"),
    )
    rules = [rule for t in names for rule in TABLE_CHECKS[t]]
    failures = F.expr(
        "CASE place " + " ".join(f"WHEN {n} THEN {rule.decide}" for n, rule in enumerate(rules)) + " END"
    ).cast("long")
    return met.select(*keys, failures.alias("failures")).withColumn("passed", F.col("failures") == 0)
