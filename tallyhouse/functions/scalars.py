"""Scalar helpers.  All are native column expressions; none leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import LANGUAGE_HINTS

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _unix_hours(timestamp: ColumnLike) -> Column:
    """Whole hours from 1970 to an instant.

    A value without a zone (TIMESTAMP_NTZ) is a wall clock in UTC.  The type is
    known when the query is planned, so one branch is all that runs.
    """
    moment = _col(timestamp)
    epoch = F.lit("1970-01-01").cast("date")
    wall = F.datediff(moment.cast("date"), epoch).cast("long") * 24 + F.hour(moment)
    instant = F.floor(F.unix_micros(moment.cast("timestamp")) / F.lit(3_600_000_000))
    return F.when(F.typeof(moment) == "timestamp_ntz", wall).otherwise(instant)


def event_date(timestamp: ColumnLike) -> Column:
    """Calendar date of an instant in UTC, whatever the session's zone is."""
    days = F.floor(_unix_hours(timestamp) / 24).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def hour_of_day(timestamp: ColumnLike) -> Column:
    """Hour 0..23 of an instant in UTC, whatever the session's zone is."""
    return F.pmod(_unix_hours(timestamp), F.lit(24)).cast("int")


def type_filter(column: ColumnLike, types: Iterable[str]) -> Column:
    """True where the column is one of ``types``."""
    return _col(column).isin(*types)


def json_texts(json_column: ColumnLike, **outputs: str) -> list[Column]:
    """Read top-level scalars of a JSON text column as strings.

    ``json_texts("repo", repo_name="name", repo_id="id")`` gives two columns.
    Missing fields, JSON nulls and malformed text give NULL; numbers keep their
    digits.  Objects and arrays give NULL.  All fields share one ``from_json`` so
    the text is parsed once per row: naming the mode stops the optimizer from
    narrowing the schema per field, which would turn it into one parse per field.
    Only a value that begins like an object or array is parsed again, to tell
    it from a string that does.
    """
    source = _col(json_column)

    def parsed(kind: str) -> Column:
        fields = ", ".join(f"`{name}` {kind}" for name in outputs.values())
        return F.from_json(source, fields, {"mode": "PERMISSIVE"})

    texts, maps, lists = parsed("STRING"), parsed("MAP<STRING, STRING>"), parsed("ARRAY<STRING>")

    def scalar(name: str) -> Column:
        text = texts[name]
        container = F.when(text.startswith("{"), maps[name].isNotNull()).when(
            text.startswith("["), lists[name].isNotNull()
        )
        return F.when(F.coalesce(container, F.lit(False)), F.lit(None)).otherwise(text)

    return [scalar(name).alias(alias) for alias, name in outputs.items()]


def split_repo(full_name: ColumnLike, index: int) -> Column:
    """Part ``index`` of an ``owner/name`` path, NULL when there is no such part."""
    return F.get(F.split(_col(full_name), "/"), F.lit(index))


def last_path_part(full_name: ColumnLike) -> Column:
    """Text after the last slash; the whole name when it has none."""
    return F.substring_index(_col(full_name), "/", -1)


def short_repo_label(full_name: ColumnLike, max_len: int = 28) -> Column:
    """Last two path parts, cut to ``max_len`` characters with an ellipsis."""
    if max_len <= 3:
        raise ValueError(f"max_len must leave room for the ellipsis, got {max_len}")
    label = F.substring_index(_col(full_name), "/", -2)
    cut = F.concat(F.substring(label, 1, max_len - 3), F.lit("..."))
    return F.when(F.length(label) > max_len, cut).otherwise(label)


def infer_language(short_name: ColumnLike) -> Column:
    """Coarse language guess from a repository's short name; NULL if unknown."""
    lowered = F.lower(_col(short_name))
    (needle, label), *later = LANGUAGE_HINTS
    return reduce(
        lambda guess, hint: guess.when(lowered.contains(hint[0]), hint[1]),
        later,
        F.when(lowered.contains(needle), label),
    )
