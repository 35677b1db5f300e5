"""Replacing dates of a stored table in two phases, so that a load can be repeated or resumed.

A load writes its partitions beside the live ones, notes in one journal entry which date is to
lie where, points the catalog at the new folders date by date, and removes the old ones.  Until
the entry is written the table is as it was and an aborted load leaves a folder that the next one
removes; from then on any later call of :func:`recover` brings the load to its end.  Each date has
its old rows or its new ones at any moment, never a part of either.

The table stays a plain partitioned table of the catalog.  One load at a time may write to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import drop_path

#: Partition column of every stored table.
DATE = "event_date"

_ENTRY = (
    "load string, dates array<struct<event_date: date, location: string, replaces: string>>"
)


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    # Of a partition, its own location comes before that of the table.
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def table_location(spark: SparkSession, table: str) -> str:
    return _location(spark, table)


def stored_dates(spark: SparkSession, table: str) -> list[date | None]:
    """Dates that have a partition, from the catalog; None is the NULL date."""
    names = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [None if n == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(n) for n in names]


def partition_spec(day: date | None) -> str:
    return f"PARTITION ({DATE} = {'NULL' if day is None else f'DATE{str(day)!r}'})"


def _folder(path: str, day: date | None) -> str:
    return f"{path}/{DATE}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


class _Files:
    """The folders of a table that hold loads and their journal."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.root = table_location(spark, table)
        self.journal = f"{self.root}/_journal"
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def data(self, load: str) -> str:
        return f"{self.root}/_loads/{load}"

    def entry(self, load: str) -> str:
        return f"{self.journal}/{load}"

    def intent(self, load: str) -> str:
        return f"{self.journal}/{load}.begun"

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.path(path))

    def drop(self, path: str) -> None:
        drop_path(self.spark, path)

    def drop_if_spent(self, path: str) -> None:
        """Remove the folder of an earlier load that has no dates left."""
        if not path.startswith(f"{self.root}/_loads/") or not self.exists(path):
            return
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path(path))]
        if not any(name.startswith(f"{DATE}=") for name in names):
            self.drop(path)

    def noted(self) -> list[str]:
        """Names in the journal."""
        if not self.exists(self.journal):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(self.journal)))

    def committed(self, load: str) -> list | None:
        """What the entry of a load says; None when it was not written to its end."""
        if not self.exists(self.entry(load)):
            return None
        rows = self.spark.read.schema(_ENTRY).json(self.entry(load)).collect()
        return rows[0].dates if rows else None


@dataclass
class Load:
    """One load of a table, in the order of its steps: write, commit, adopt, clean."""

    spark: SparkSession
    table: str
    name: str

    @classmethod
    def begin(cls, spark: SparkSession, table: str) -> Load:
        """A new load, after earlier ones were brought to an end."""
        recover(spark, table)
        load = cls(spark, table, uuid.uuid4().hex)
        files = _Files(spark, table)
        files.make(files.intent(load.name))
        return load

    def write(self, rows: DataFrame) -> None:
        """Write rows of the table's columns into the load's own folder, by date."""
        path = _Files(self.spark, self.table).data(self.name)
        rows.write.mode("append").partitionBy(DATE).parquet(path)

    def commit(self, filled: Iterable[date | None], emptied: Iterable[date | None] = ()) -> None:
        """Note where the dates written lie, and which dates have no rows any more."""
        files = _Files(self.spark, self.table)
        known = set(stored_dates(self.spark, self.table))

        def replaced(day: date | None) -> str | None:
            if day not in known:
                return None
            return _location(self.spark, self.table, partition_spec(day))

        dates = [(d, _folder(files.data(self.name), d), replaced(d)) for d in filled]
        dates += [(d, None, replaced(d)) for d in emptied if d in known]
        # One row is one file, which appears whole or not at all.
        entry = self.spark.createDataFrame([(self.name, dates)], _ENTRY)
        entry.coalesce(1).write.json(files.entry(self.name))

    def adopt(self) -> None:
        """Point the catalog at what the journal says; the same however often it is done."""
        dates = _Files(self.spark, self.table).committed(self.name) or []
        known = set(stored_dates(self.spark, self.table))
        new = [(day, path) for day, path, _ in dates if path and day not in known]
        gone = [day for day, path, _ in dates if path is None and day in known]
        if new:
            added = " ".join(f"{partition_spec(day)} LOCATION '{path}'" for day, path in new)
            self.spark.sql(f"ALTER TABLE {self.table} ADD {added}")
        for day, path, _ in dates:
            if path and day in known:
                spec = partition_spec(day)
                self.spark.sql(f"ALTER TABLE {self.table} {spec} SET LOCATION '{path}'")
        if gone:
            # Dropping removes the files of a managed table; the rest goes with clean().
            dropped = ", ".join(map(partition_spec, gone))
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {dropped}")
        self.spark.catalog.refreshTable(self.table)

    def clean(self) -> None:
        """Remove what the load replaced, then its journal entry."""
        files = _Files(self.spark, self.table)
        for _, location, replaced in files.committed(self.name) or []:
            if replaced and replaced not in (location, files.root):
                files.drop(replaced)
                files.drop_if_spent(replaced.rsplit("/", 1)[0])
        files.drop(files.entry(self.name))
        files.drop(files.intent(self.name))

    def abandon(self) -> None:
        """Remove a load that was not committed."""
        files = _Files(self.spark, self.table)
        files.drop(files.data(self.name))
        files.drop(files.entry(self.name))
        files.drop(files.intent(self.name))


def recover(spark: SparkSession, table: str) -> list[str]:
    """Bring interrupted loads of a table to an end; returns the committed ones among them.

    A load with a journal entry is adopted, one without is removed.
    """
    files = _Files(spark, table)
    noted = files.noted()
    finished = []
    for name in sorted({n.removesuffix(".begun") for n in noted}):
        load = Load(spark, table, name)
        if files.committed(name) is None:
            load.abandon()
        else:
            load.adopt()
            load.clean()
            finished.append(name)
    return finished


def publish(
    spark: SparkSession,
    table: str,
    parts: Sequence[DataFrame],
    filled: Iterable[date | None],
    emptied: Iterable[date | None] = (),
) -> None:
    """Replace the dates ``filled`` by the rows of ``parts``, and take ``emptied`` away.

    ``parts`` have the table's columns, the date last, and rows of the dates ``filled`` only;
    they may read the table.
    """
    load = Load.begin(spark, table)
    for rows in parts:
        load.write(rows)
    load.commit(filled, emptied)
    load.adopt()
    load.clean()
