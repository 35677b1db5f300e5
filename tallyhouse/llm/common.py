"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path, write_through

#: White space between words, for Java and for Python patterns.
SPACE = r"[\x20\x09-\x0D]+"
#: The same characters, for trimming.
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: A word.
WORD = r"[^\x20\x09-\x0D]+"

#: Largest table that is broadcast, in bytes of its files; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is the only name Spark gives to an intermediate value
    inside one expression: a plain reuse of ``value`` is computed again at each
    use, inside another lambda once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text, unchanged and in order."""
    return F.array_remove(F.split(text, SPACE), "")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, as a plain file scan."""
    return write_through(df, f"llm-{purpose}")[0]


def small(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when its rows are known to fit, else as it is.

    ``df`` is a stored table, so counting it reads file footers.
    """
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values of ``columns`` alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@lru_cache(maxsize=8)
def _shipped(application: str) -> str:
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tallyhouse-")) / "tallyhouse-package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(Path(package.name) / file.relative_to(package)))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run there."""
    path = _shipped(spark.sparkContext.applicationId)
    if path not in _SENT:
        spark.sparkContext.addPyFile(path)
        _SENT.add(path)


_SENT: set[str] = set()


__all__ = [
    "BROADCAST_BYTES", "SPACE", "SPACE_CHARS", "WORD", "documents", "let", "partitions",
    "scratch_path", "ship", "small", "stored", "text_or_empty", "uniform", "words_of",
]
