"""Quality rules: figures of one text, and lines that too many documents of a host share.

Native columns throughout.  Lines are hashed once, into a stored table of one row per
line of each distinct text.  Which lines are frequent, and what a text loses by them,
follow from that table alone; a text is read again for its figures only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import (
    BROADCAST_BYTES, SPACE, SPACE_CHARS, let, small, stored, text_or_empty, words_of,
)


@dataclass(frozen=True)
class LineLimits:
    """When a line is removed and when a document is rejected for it.

    A line is removed when it stands in more than ``min_documents`` distinct
    documents of a host, however many the host has.  A document is rejected when
    less than ``min_kept`` of its words are in the lines left.
    """

    min_documents: int = 20
    min_kept: float = 0.3


#: Words of one repeat window.
WINDOW = 5


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS))


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def text_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """(host, document, position, line, words): each line with a word of each distinct text.

    ``line`` is the hash of the normalised line: trimmed, in lower case.  Equal texts
    of a host are one document, so copies of a good document do not make its lines
    frequent; they are combined before the shuffle.
    """
    text = text_or_empty()
    split = docs.select(
        F.col(host).alias("host"),
        _text_key(text).alias("document"),
        F.posexplode(F.transform(F.split(text, "\n"), _trimmed)).alias("position", "said"),
    )
    return (
        split.filter(F.col("said") != "")
        .select(
            "host", "document", "position",
            F.xxhash64(_trimmed(F.lower("said"))).alias("line"),
            F.size(F.split("said", SPACE)).alias("words"),
        )
        .distinct()
    )


def frequent_lines(lines: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """(host, line, documents) of the lines to remove, from :func:`text_lines`.

    Counts are combined by (host, line, document) before they are combined by
    (host, line), which spreads a line that is everywhere.
    """
    counts = lines.groupBy("host", "line").agg(F.countDistinct("document").alias("documents"))
    return counts.filter(F.col("documents") > limits.min_documents)


#: A line in more than one of so many rows of lines is joined by broadcast.
_HOT = 100_000


def _frequent_rows(lines: DataFrame, frequent: DataFrame, limit: int) -> DataFrame:
    """Rows of ``lines`` whose line is in ``frequent``; both are stored tables.

    A list of more than ``limit`` bytes is joined by shuffle, but for its lines that
    are in more than one of ``_HOT`` rows: there are at most ``_HOT`` of them.
    """

    def joined(some: DataFrame) -> DataFrame:
        keys = some.select(F.col("host").alias("h"), F.col("line").alias("l"))
        return lines.join(keys, F.expr("host <=> h AND line = l"), "left_semi")

    if frequent.count() * 40 <= limit:
        return joined(F.broadcast(frequent))
    hot = F.col("documents") * _HOT > lines.count()
    few, rest = F.broadcast(frequent.filter(hot)), frequent.filter(~hot)
    keys = few.select(F.col("host").alias("h"), F.col("line").alias("l"))
    others = lines.join(keys, F.expr("host <=> h AND line = l"), "left_anti")
    cold = rest.select(F.col("host").alias("h"), F.col("line").alias("l"))
    return joined(few).unionAll(others.join(cold, F.expr("host <=> h AND line = l"), "left_semi"))


def depleted_texts(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    host: str = "source",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(hit_host, hit_document, hit_words, hit_lines): what a text that holds frequent lines loses.

    One row per distinct text of a host: the words in those lines, and their positions.
    """
    lines = stored(text_lines(docs, host), "text-lines")
    frequent = stored(frequent_lines(lines, limits), "frequent-lines")
    return (
        _frequent_rows(lines, frequent, limit)
        .groupBy(F.col("host").alias("hit_host"), F.col("document").alias("hit_document"))
        .agg(F.sum("words").alias("hit_words"), F.collect_list("position").alias("hit_lines"))
    )


def _with_hits(rows: DataFrame, hits: DataFrame, bytes_per_row: int, limit: int) -> DataFrame:
    """``rows`` (host, document and others) with the columns of ``hits``, a stored table.

    Beyond ``limit`` this is a shuffle; a text that many rows share is then a large
    partition of ``rows`` alone, which adaptive execution splits.
    """
    hits = small(hits, bytes_per_row, limit)
    return rows.join(hits, F.expr("host <=> hit_host AND document = hit_document"), "left")


def _window_hashes(words: DataFrame) -> DataFrame:
    """``words`` with ``windows``: a hash of each window of five words.

    Built by doubling, from hashes of words to those of pairs, fours and fives:
    one short lambda call per word and step.  Each step is a column of its own, for
    a lambda that held the step before it would compute that once per element.
    """

    def joined(left: str, right: str, shift: int) -> Column:
        n = F.greatest(F.size("hashes") - shift, F.lit(0))
        return F.zip_with(
            F.slice(left, F.lit(1), n),
            F.slice(right, F.lit(shift + 1), n),
            lambda x, y: F.xxhash64(x, y),
        )

    hashed = words.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    pairs = hashed.withColumn("pairs", joined("hashes", "hashes", 1))
    last = WINDOW - 1
    fours = pairs.withColumn("fours", joined("pairs", "pairs", 2))
    n = F.greatest(F.size("hashes") - last, F.lit(0))
    return fours.withColumn(
        "windows",
        F.zip_with(
            F.slice("fours", F.lit(1), n),
            F.slice("hashes", F.lit(WINDOW), n),
            lambda x, y: F.xxhash64(x, y),
        ),
    )


def _covered_words(windows: Column) -> Column:
    """Words in windows found twice or more, the first one included."""

    def starts_of(ordered: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            equal = F.get(ordered, i)["h"] == F.get(ordered, j)["h"]
            return F.coalesce(equal, F.lit(False))

        repeated = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: same(i, i - 1) | same(i, i + 1)
        )
        return F.sort_array(F.transform(repeated, lambda i: F.get(ordered, i)["at"]))

    def covered(starts: Column) -> Column:
        # least() passes over the NULL after the last start.
        widths = F.transform(
            starts, lambda at, i: F.least(F.lit(WINDOW), F.get(starts, i + 1) - at)
        )
        return F.aggregate(widths, F.lit(0), lambda total, width: total + width)

    placed = F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    return let(F.sort_array(placed), lambda o: let(starts_of(o), covered))


#: Figures of a text, all bigint.
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_figures(texts: DataFrame) -> DataFrame:
    """``texts`` (text and any columns but those made here) with :data:`FIGURES`."""
    text = F.col("text")
    with_word = F.filter(F.split(text, "\n"), lambda x: _trimmed(x) != "")
    split = texts.withColumns({"words": words_of(text), "lines": with_word})
    hashed = _window_hashes(split)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    numbers = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.when(repeats, _covered_words(F.col("windows"))).otherwise(F.lit(0)),
    }
    return hashed.select(
        *texts.columns, *[number.cast("long").alias(name) for name, number in numbers.items()]
    )


def _verdicts(limits: LineLimits) -> tuple[Column, Column]:
    """(base_failed, kept) from the figures and removed_words."""
    n_words = F.col("n_words")
    failed = (n_words < 10) | (100 * F.col("n_repeat_words") > 20 * n_words)
    left = n_words - F.col("removed_words")
    return failed, ~failed & (left >= limits.min_kept * n_words)


def _without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines at the positions ``gone``."""

    def rest(lines: Column) -> Column:
        every = F.transform(lines, lambda _, i: i)
        return F.array_join(
            F.transform(F.array_except(every, gone), lambda i: F.get(lines, i)), "\n"
        )

    return let(F.split(text, "\n"), rest)


def judge_quality(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    host: str = "source",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` as the struct ``row``, with ``figures``, ``removed_words``,
    ``base_failed``, ``kept`` and ``kept_text``.

    * The line rule counts over all of ``docs``, rejected documents included.
    * A NULL text is an empty one: no words, hence ``base_failed``.
    * A NULL host is a host of its own.
    * Repeated rows are judged alike; equal texts count as one document.
    * ``kept_text`` is the text without the removed lines, and the text itself
      when no line is removed.
    * An empty table gives an empty result; other columns stay in ``row``
      whatever their names.

    Tables of more than ``limit`` bytes are joined by shuffle.
    """
    hits = stored(depleted_texts(docs, limits, host, limit), "depleted-texts")
    width = 64 + 8 * int(hits.agg(F.max(F.size("hit_lines"))).first()[0] or 0)
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    keyed = rows.select(
        "row", F.col("row")[host].alias("host"), text.alias("text"), _text_key(text).alias("document")
    )
    measured = with_figures(_with_hits(keyed, hits, width, limit))
    removed = F.coalesce("hit_words", F.lit(0)).cast("long")
    failed, kept = _verdicts(limits)
    return measured.withColumn("removed_words", removed).select(
        "row",
        F.struct(*FIGURES).alias("figures"),
        "removed_words",
        failed.alias("base_failed"),
        kept.alias("kept"),
        F.when(F.col("hit_lines").isNull(), F.col("row.text"))
        .otherwise(_without_lines(F.col("text"), F.col("hit_lines")))
        .alias("kept_text"),
    )


def quality_report(
    docs: DataFrame, limits: LineLimits = LineLimits(), limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Per document: doc_id, its figures, base_failed, kept and removed_words.

    As :func:`judge_quality`, without moving a text: figures are joined, not rows.
    """
    hits = depleted_texts(docs, limits, limit=limit).drop("hit_lines")
    text = text_or_empty()
    keyed = docs.select(
        "doc_id", F.col("source").alias("host"), text.alias("text"), _text_key(text).alias("document")
    )
    figures = with_figures(keyed).drop("text")
    joined = _with_hits(figures, stored(hits, "depleted-texts"), 64, limit)
    failed, kept = _verdicts(limits)
    return joined.withColumn(
        "removed_words", F.coalesce("hit_words", F.lit(0)).cast("long")
    ).select("doc_id", *FIGURES, failed.alias("base_failed"), kept.alias("kept"), "removed_words")


def keep_quality(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Documents that pass, without the removed lines, in the columns of ``docs``."""
    judged = judge_quality(docs, limits).filter("kept")
    return judged.select("row.*", F.col("kept_text").alias("__kept_text")).select(
        *[
            F.col("__kept_text").alias("text")
            if c == "text"
            else F.length("__kept_text").cast("long").alias("n_chars")
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
