"""Where hourly files lie, which of them have landed, which are missing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schemas import RETENTION_DAYS
from tallyhouse.session import drop_path

DateLike = date | str


def as_date(value: DateLike) -> date:
    """A date from a date or ``YYYY-MM-DD`` text; anything else is a ValueError."""
    return value if isinstance(value, date) else date.fromisoformat(value)


def days(start: DateLike, end: DateLike) -> list[date]:
    """Every date from ``start`` to ``end``, both included."""
    first, last = as_date(start), as_date(end)
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    return [first + timedelta(n) for n in range((last - first).days + 1)]


def _either(options: Iterable[str]) -> str:
    listed = list(options)
    return listed[0] if len(listed) == 1 else "{" + ",".join(listed) + "}"


def _printf(number: re.Match) -> str:
    # The second argument, in the same width as Python's format for whole numbers.
    return f"%2${number[1].removesuffix('d')}d"


@dataclass(frozen=True)
class Landing:
    """Path layout of landed files below ``root``.

    ``hour_file`` names one hour by ``{date}`` and ``{hour}`` (with any format
    for the number), ``day_files`` is the folder, or a glob for the files, of
    whatever has landed for a date, and ``daily_file`` is the older layout with
    one file per date.
    """

    root: str
    # Landed layout.
    hour_file: str = "{date}/hours/{hour:02d}.ndjson"
    day_files: str = "{date}/hours"
    daily_file: str = "{date}/events.ndjson"

    @classmethod
    def daily(cls, root: str) -> Landing:
        """The older layout: one file per date."""
        return cls(root, day_files=cls.daily_file)

    @classmethod
    def archive(cls, root: str) -> Landing:
        """Layout of the public hourly archives: one flat folder, plain hour numbers."""
        return cls(root, hour_file="{date}-{hour}.json.gz", day_files="{date}-*.json.gz")

    def _at(self, relative: str) -> str:
        return f"{self.root.rstrip('/')}/{relative}"

    def hour_path(self, day: DateLike, hour: int) -> str:
        """Path of one hour."""
        return self._at(self.hour_file.format(date=as_date(day), hour=hour))

    def daily_path(self, day: DateLike) -> str:
        """Path of a date in the older one-file layout."""
        return self._at(self.daily_file.format(date=as_date(day)))

    def hour_path_of(self, day: Column, hour: Column) -> Column:
        """Path of one hour, from columns of dates and hours."""
        template = re.sub(r"\{hour:?([^}]*)\}", _printf, self.hour_file.replace("%", "%%"))
        return self._formatted(template, day, hour)

    def daily_path_of(self, day: Column) -> Column:
        """Path of a date in the older one-file layout, from a column of dates."""
        return self._formatted(self.daily_file.replace("%", "%%"), day)

    def _formatted(self, template: str, day: Column, *others: Column) -> Column:
        template = template.replace("{date}", "%1$s")
        below = F.format_string(template, F.date_format(day, "yyyy-MM-dd"), *others)
        known = [value.isNotNull() for value in (day, *others)]
        return F.when(reduce(and_, known), F.concat(F.lit(self._at("")), below))

    def hour_paths(self, day: DateLike, start: int = 0, count: int = 24) -> list[str]:
        """Paths of the hours ``[start, start + count)`` of a date."""
        return [self.hour_path(day, hour) for hour in range(start, start + count)]

    def day_glob(self, dates: Sequence[DateLike]) -> str:
        """One glob for everything that has landed on ``dates``.

        A load of a date always takes the whole date, also when the run asked
        for fewer hours.
        """
        named = (d if d == "*" else str(as_date(d)) for d in dates)
        return self._at(self.day_files.format(date=_either(named)))

    def _date_pattern(self) -> str:
        # The date as the glob for a date's files has it; what follows is left open.
        before = self.day_files.split("{date}")[0]
        return "/" + re.escape(before) + r"(\d{4}-\d{2}-\d{2})(?!\d)"

    def date_of(self, path: str) -> date | None:
        """Date a landed file belongs to, whatever its name."""
        match = re.search(self._date_pattern(), path)
        return match and date.fromisoformat(match[1])

    def _pattern(self) -> str:
        # What follows the hour is left open, so 01.json.gz counts as hour 01.
        before, after_date = self.hour_file.split("{date}")
        between = re.split(r"\{hour[^}]*\}", after_date)[0]
        day, hour = r"(\d{4}-\d{2}-\d{2})", r"(\d{1,2})(?!\d)"
        return "/" + re.escape(before) + day + re.escape(between) + hour

    def hour_of(self, path: str) -> tuple[date, int] | None:
        """Date and hour a landed file belongs to, from its path."""
        match = re.search(self._pattern(), path)
        return match and (date.fromisoformat(match[1]), int(match[2]))

    def file_date(self, path: Column) -> Column:
        """Date a landed file belongs to, whatever its name, from a column of paths."""
        return F.to_date(F.nullif(F.regexp_extract(path, self._date_pattern(), 1), F.lit("")))

    def file_hour(self, path: Column) -> Column:
        """Hour a landed file belongs to, from a column of paths."""
        return F.nullif(F.regexp_extract(path, self._pattern(), 2), F.lit("")).cast("int")


def landed_files(spark: SparkSession, glob: str) -> list[str]:
    """Paths of the files a glob names: a listing, no data is read."""
    try:
        reader = spark.read.option("recursiveFileLookup", "true")
        return sorted(reader.text(glob).inputFiles())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def list_hours(
    spark: SparkSession, landing: Landing, dates: Sequence[DateLike]
) -> list[tuple[date, int]]:
    """Date and hour of every landed file of ``dates`` that is named by an hour.

    As long as the hours of ``dates`` have files; several parts of an hour count once.
    """
    files = landed_files(spark, landing.day_glob(dates))
    return sorted({hour for hour in map(landing.hour_of, files) if hour})


def list_dates(spark: SparkSession, landing: Landing, dates: Sequence[DateLike]) -> list[date]:
    """Those of ``dates`` for which any file has landed, whatever its name."""
    files = landed_files(spark, landing.day_glob(dates))
    return sorted({day for day in map(landing.date_of, files) if day})


def expire_landed(
    spark: SparkSession, landing: Landing, as_of: DateLike, keep_days: int = RETENTION_DAYS
) -> list[str]:
    """Delete landed files of dates older than ``keep_days`` before ``as_of``; returns them.

    Files whose path has no date stay.
    """
    oldest = as_date(as_of) - timedelta(keep_days)
    every = landed_files(spark, landing.day_glob(["*"]))
    expired = [f for f in every if (day := landing.date_of(f)) is not None and day < oldest]
    for path in expired:
        drop_path(spark, path)
    return expired


#: Columns of a listing of landed files.
LISTING = "path string, length long, modified timestamp, event_date date, hour_of_day int"


def file_listing(spark: SparkSession, landing: Landing, dates: Sequence[DateLike]) -> DataFrame:
    """One row per landed file of ``dates`` (``*`` for all), in the columns of ``LISTING``.

    Spark lists the folders and nothing of a file is read.  Files not named by an hour
    have none.  Files without a byte, as Spark sees no use in them, and files whose path has
    no date are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(landing.day_glob(dates))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    path = F.col("_metadata.file_path")
    return files.select(
        path.alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
        landing.file_date(path).alias("event_date"),
        landing.file_hour(path).alias("hour_of_day"),
    ).filter("event_date IS NOT NULL")


def landed_hours(spark: SparkSession, landing: Landing, dates: Sequence[DateLike]) -> DataFrame:
    """(event_date, hour_of_day) of the hours that have landed."""
    files = file_listing(spark, landing, dates).filter("hour_of_day IS NOT NULL")
    return files.select("event_date", "hour_of_day").distinct()


def hour_grid(
    spark: SparkSession, start: DateLike, end: DateLike, first_hour: int = 0, count: int = 24
) -> DataFrame:
    """Every (event_date, hour_of_day) of a date range and hour window."""
    first, last = as_date(start), as_date(end)
    hours = F.sequence(F.lit(first_hour), F.lit(first_hour + count - 1))
    return (
        spark.range((last - first).days + 1)
        .select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("event_date"))
        .select("event_date", F.explode(hours).alias("hour_of_day"))
    )


def missing_hours(
    landed: DataFrame, start: DateLike, end: DateLike, first_hour: int = 0, count: int = 24
) -> DataFrame:
    """Hours of the range with no row in ``landed``; those that exist are reused."""
    grid = hour_grid(landed.sparkSession, start, end, first_hour, count)
    seen = landed.select("event_date", "hour_of_day").distinct()
    return grid.join(seen, ["event_date", "hour_of_day"], "left_anti")
