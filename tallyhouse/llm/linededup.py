"""Line deduplication across documents, with keep bitmaps as its result.

Lines travel as two 64-bit hashes and the document they are in, never as text.  The hashes are
range-partitioned and sorted within each range by document and position, so that one pass
streams the first occurrences; what comes back to a document is a bitmap of the lines it keeps.

A line that a third of all documents have is one hash.  Ranges therefore run over the hash and
a block of documents: each block names the first few documents that have the line, and only
those are brought together over the blocks.  Native columns throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import SPACE_CHARS, let, partitions, small, stored, text_or_empty

#: Code points of the shortest line that is judged, documents it must be in.
MIN_CHARS = 20
MIN_DOCS = 3

#: Lines of one hash that a block holds, about, and the least number of blocks.
BLOCK_LINES = 1 << 22
BLOCKS = 64
#: Bytes of a line's entry, and of a range of entries.
_ENTRY_BYTES = 48
_RANGE_BYTES = 128 * 1024 * 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD_LINES = 64


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    trimmed = F.btrim(line, F.lit(SPACE_CHARS))
    plain = F.octet_length(trimmed) == F.length(trimmed)
    # The lower case of plain ASCII is a fast path; other letters must stay as they are.
    return F.when(plain, F.lower(trimmed)).otherwise(F.translate(trimmed, _UPPER, _UPPER.lower()))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.lit(3), text)


def _entries(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, pos) of every judged line of the documents with an id."""
    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_or_empty().alias("text"))
    lines = texts.select(
        "doc_id",
        _text_hash(F.col("text")).alias("text_hash"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"),
    )
    judged = lines.filter(F.length(F.btrim("line", F.lit(SPACE_CHARS))) >= min_chars)
    key = line_key(F.col("line"))
    return judged.select(
        F.xxhash64(F.lit(1), key).alias("h1"),
        F.xxhash64(F.lit(2), key).alias("h2"),
        "doc_id",
        "text_hash",
        "pos",
    ).distinct()


def _first_documents(entries: DataFrame, ranges: int, min_docs: int, last_first: bool) -> DataFrame:
    """(h1, h2, block, doc_id, pos): a line's first occurrence in the first documents of a block.

    One stream over the sorted ranges; ``min_docs`` documents of a block are enough to tell
    whether so many have the line and which of them comes first.
    """
    doc = F.col("doc_id").desc() if last_first else F.col("doc_id").asc()
    placed = entries.select("h1", "h2", "block", "doc_id", "pos").repartitionByRange(
        ranges, "h1", "h2", "block"
    )
    stream = Window.partitionBy("h1", "h2", "block").orderBy(doc, "pos")
    before = F.lag("doc_id").over(stream)
    heads = placed.withColumn("before", before).filter(
        F.col("before").isNull() | (F.col("before") != F.col("doc_id"))
    )
    ranked = heads.withColumn("place", F.row_number().over(stream))
    return ranked.filter(F.col("place") <= min_docs).drop("before", "place")


def _frequent(first: DataFrame, min_docs: int, last_first: bool) -> DataFrame:
    """(h1, h2, block, top_doc, top_pos) of lines that ``min_docs`` documents have, per block.

    ``top_doc`` keeps the line.  A hash has at most ``min_docs`` rows per block, combined
    before they are moved.
    """
    if last_first:
        top = F.max(F.struct("doc_id", (-F.col("pos")).alias("turned")))
        pos = -F.col("top.turned")
    else:
        top = F.min(F.struct("doc_id", F.col("pos").alias("turned")))
        pos = F.col("top.turned")
    grouped = first.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("docs"), top.alias("top"), F.collect_set("block").alias("blocks")
    )
    return grouped.filter(F.col("docs") >= min_docs).select(
        "h1",
        "h2",
        F.explode("blocks").alias("block"),
        F.col("top.doc_id").alias("top_doc"),
        pos.alias("top_pos"),
    )


def _bitmaps(lost: DataFrame) -> DataFrame:
    """(doc_id, text_hash, keep) from the lost lines (doc_id, text_hash, pos)."""
    words = (
        lost.repartition("doc_id", "text_hash")
        .groupBy("doc_id", "text_hash", F.floor(F.col("pos") / _WORD_LINES).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {_WORD_LINES})")).alias("bits"))
    )
    listed = words.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )

    def entry(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col("words"), i - 1)["word"], F.lit(-1))
        return F.struct((x["word"] - before - 1).alias("whole"), F.bitwise_not(x["bits"]).alias("keep"))

    return listed.select("doc_id", "text_hash", F.transform("words", entry).alias("keep"))


def keep_bitmaps(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    last_first: bool = True,
    once: bool = False,
) -> DataFrame:
    """(doc_id, text_hash, keep) of every document that loses lines, as a stored table.

    A line is judged by its key (see :func:`line_key`) when that has ``min_chars`` code points.
    A key in ``min_docs`` documents or more is kept by the first document that has it only,
    the one with the largest id with ``last_first``, else the smallest; with ``once`` that
    document keeps its first such line only.

    ``keep`` is a bitmap with whole stretches left out: each entry stands for ``whole`` times
    64 lines that are all kept and then 64 lines of which the set bits are kept; lines after
    the last entry are kept.  ``text_hash`` tells rows with one id and different texts apart.

    * Rows without an id lose nothing and do not count; NULL is the empty text.
    * Rows with one id are one document, however many; equal rows are judged once.
    * Lines are taken for equal when 128 bits of hashes are.
    * An empty table gives an empty result; other columns are not read.
    """
    plain = stored(_entries(docs, min_chars), "line-hashes")
    n = plain.count()
    blocks = max(BLOCKS, -(-n // BLOCK_LINES))
    ranges = max(partitions(docs.sparkSession), -(-n * _ENTRY_BYTES // _RANGE_BYTES))
    entries = plain.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(blocks)))
    first = _first_documents(entries, ranges, min_docs, last_first)
    frequent = stored(_frequent(first, min_docs, last_first), "frequent-lines")
    met = entries.join(small(frequent, 96), ["h1", "h2", "block"])
    elsewhere = F.col("doc_id") != F.col("top_doc")
    lost = met.filter(elsewhere | (F.col("pos") != F.col("top_pos")) if once else elsewhere)
    return stored(_bitmaps(lost.select("doc_id", "text_hash", "pos")), "keep-bitmaps")


def _kept(lines: Column, keep: Column) -> Column:
    words = F.flatten(
        F.transform(
            keep, lambda x: F.concat(F.array_repeat(F.lit(-1).cast("long"), x["whole"]), F.array(x["keep"]))
        )
    )

    def stays(word: Column, i: Column) -> Column:
        return word.isNull() | (F.getbit(word, i % _WORD_LINES) == 1)

    return let(
        words,
        lambda w: F.filter(
            lines, lambda line, i: stays(F.get(w, F.floor(i / _WORD_LINES).cast("int")), i)
        ),
    )


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` as the struct ``row``, with ``n_lines``, ``n_dropped`` and ``kept_text``.

    The bitmaps are joined to the texts, by broadcast when they are known to be small; rows
    without an id are spread by their text.  Equal rows get equal results.
    """
    marks = bitmaps.select(
        F.col("doc_id").alias("mark_doc"), F.col("text_hash").alias("mark_text"), "keep"
    )
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.coalesce(F.col("row")["text"], F.lit("")).alias("said"),
        F.col("row")["doc_id"].alias("said_by"),
    )
    rows = rows.withColumn("said_hash", _text_hash(F.col("said")))
    same = F.col("said_by").eqNullSafe(F.col("mark_doc")) & (F.col("said_hash") == F.col("mark_text"))
    marked = rows.join(small(marks, 256), same, "left")
    lines = F.split("said", "\n")
    dropped = F.aggregate(
        "keep", F.lit(0), lambda total, x: total + F.bit_count(F.bitwise_not(x["keep"]))
    )
    return marked.select(
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("said"))
        .otherwise(F.array_join(_kept(lines, F.col("keep")), "\n"))
        .alias("kept_text"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document.

    See :func:`keep_bitmaps` for rows without an id, repeats and empty texts; an empty text
    is one empty line.
    """
    texts = docs.select("doc_id", "text")
    judged = without_lines(texts, keep_bitmaps(texts))
    return judged.select(
        F.col("row")["doc_id"].alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )
