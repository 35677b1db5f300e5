"""Scans of newline-delimited JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import BAD_RECORD_LIMIT, RAW_SCHEMA
from tallyhouse.session import drop_path, write_through
from tallyhouse.sources.landing import DateLike, Landing, as_date

#: Column that holds the text of a record that does not fit the schema.
CORRUPT = "_corrupt_record"

#: Gzip files above this size are spread over several tasks after they are parsed.
LARGE_FILE = 256 * 1024 * 1024


class BadRecordsError(ValueError):
    """A load holds more malformed records than allowed."""

    def __init__(self, found: int, limit: int, where: str = "load"):
        super().__init__(f"{where}: {found} malformed records, at most {limit} allowed")
        self.found = found
        self.limit = limit


def _good(df: DataFrame) -> DataFrame:
    """Well-formed records of a scan.

    Spark parses only the columns a query uses and would let a record pass that
    is wrong in another one.  The second test is always true and names every
    column, so a record is judged whole whatever is selected later.
    """
    values = [c for c in df.columns if c != CORRUPT]
    whole = F.xxhash64(*values) % 1 == 0
    return df.filter(F.col(CORRUPT).isNull() & whole).drop(CORRUPT)


def scan_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = RAW_SCHEMA,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Records of plain or gzip NDJSON files under an explicit schema.

    Fields outside the schema are dropped and blank lines skipped.  A string
    field over a JSON object keeps the object's text.  Compression follows the
    file suffix; a gzip file cannot be split and is one task, so parallelism is
    the number of hours read (see :func:`spread_large`).

    Malformed records are left out, or kept with their text in
    ``_corrupt_record`` when ``keep_corrupt`` is set.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    scan = (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .json([paths] if isinstance(paths, str) else list(paths))
    )
    return scan if keep_corrupt else _good(scan)


def is_large_gzip(large_bytes: int = LARGE_FILE) -> Column:
    """Records of gzip files above ``large_bytes``; decided when files are listed."""
    path, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    return path.endswith(".gz") & (size > large_bytes)


def spread_large(scan: DataFrame, large_bytes: int = LARGE_FILE) -> DataFrame:
    """``scan`` with the records of gzip files over ``large_bytes`` dealt over several tasks.

    The sizes are those of the listing: each branch lists its own files, so every file is parsed
    once and the others stay as they lie.  How many tasks the records of large files become
    follows from their measured size, through adaptive execution.
    """
    large = is_large_gzip(large_bytes)
    return scan.filter(~large).unionAll(scan.filter(large).hint("rebalance"))


def bad_record_budget(df: DataFrame, limit: int = BAD_RECORD_LIMIT) -> DataFrame:
    """Good records of a ``keep_corrupt`` scan, or BadRecordsError beyond ``limit``.

    The scan is parsed once, into shared scratch, which the result reads.
    """
    parsed, path = write_through(df, "parsed-records")
    found = parsed.filter(F.col(CORRUPT).isNotNull()).count()
    if found > limit:
        drop_path(df.sparkSession, path)
        raise BadRecordsError(found, limit)
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def combine_hours(
    spark: SparkSession,
    landing: Landing,
    dates: Sequence[DateLike],
    keep_corrupt: bool = False,
    large_bytes: int | None = None,
    file_path: str | None = None,
) -> DataFrame:
    """All landed hours of ``dates`` as one dataset with the date of each file.

    Absent hours add nothing; when nothing has landed the result is empty.  With
    ``large_bytes``, gzip hours above it are spread over several tasks after they are parsed.
    ``file_path`` names a column for the file of each record.
    """
    try:
        scan = scan_ndjson(spark, landing.day_glob(dates), keep_corrupt=keep_corrupt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        fields = [*RAW_SCHEMA.fields]
        if keep_corrupt:
            fields.append(T.StructField(CORRUPT, T.StringType()))
        scan = spark.createDataFrame([], T.StructType(fields))
        undated = scan.withColumn("file_date", F.lit(None).cast("date"))
        return undated.withColumn(file_path, F.lit(None).cast("string")) if file_path else undated
    if len(dates) == 1:
        file_date = F.lit(as_date(dates[0]))
    else:
        file_date = landing.file_date(F.col("_metadata.file_path"))
    dated = scan.withColumn("file_date", file_date)
    if file_path:
        dated = dated.withColumn(file_path, F.col("_metadata.file_path"))
    return dated if large_bytes is None else spread_large(dated, large_bytes)


def count_records(spark: SparkSession, landing: Landing, dates: Sequence[DateLike]) -> DataFrame:
    """Non-blank lines per landed hour, without parsing them."""
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text(landing.day_glob(dates)).filter(F.trim("value") != "")
    path = F.col("_metadata.file_path")
    return (
        lines.select(
            landing.file_date(path).alias("event_date"),
            landing.file_hour(path).alias("hour_of_day"),
        )
        .groupBy("event_date", "hour_of_day")
        .agg(F.count(F.lit(1)).alias("records"))
    )
