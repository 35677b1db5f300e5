"""Packing documents into sequences: bounded-space online best-fit.

A task keeps a fixed number of open sequences.  A piece goes to the fullest one it
fits in, found as the lowest bit of a bitset keyed by free space; when it fits
nowhere a new one is opened, and if that is one too many the fullest is closed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship, stored
from tallyhouse.llm.tokens import encoded_batches, public_tokenizer

#: Tokens of a sequence.
LENGTH = 2048
#: Open sequences of a task, and pieces it meets in one round.
OPEN = 4096
ROUND = 4096
#: Tokens packed by one task, about.
TASK_TOKENS = 64_000_000
#: Id after each document.
END_ID = 0

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Sequences that still take pieces, at most ``bound`` of them."""

    def __init__(self, length: int, bound: int):
        self.length = length
        self.bound = bound
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.free_sizes = 0
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.free_sizes &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``size`` tokens, 1 to the length of a sequence."""
        fitting = self.free_sizes >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.length, self.made
            self.made += 1
        left = free - size
        if left:
            if self.open == self.bound:
                fullest = (self.free_sizes & -self.free_sizes).bit_length() - 1
                if fullest >= left:
                    # The sequence at hand is the fullest.
                    return number, self.length - free
                self._take(fullest)
            self.by_free[left].append(number)
            self.free_sizes |= 1 << left
            self.open += 1
        return number, self.length - free


def _cutting(path: str, length: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded_batches(batches, path, keeps_space=False, end_id=end_id):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            counts = -(-sizes // length)
            doc = np.repeat(np.arange(len(ids)), counts)
            piece = np.concatenate([np.arange(n) for n in counts]) if len(counts) else counts
            start = piece * length
            size = np.minimum(sizes[doc] - start, length)
            crcs = [
                zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes())
                for d, s, n in zip(doc, start, size)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(size),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def token_pieces(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Pieces of at most ``length`` tokens; only longer documents are cut."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cutting(path, length, end_id), _PIECES)


def _packing(length: int, bound: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, bound)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(size) for size in batch["length"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([first + n for n, _ in placed], pa.int64()),
                    pa.array([at for _, at in placed], pa.int64()),
                ],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return pack


def pack_pieces(
    pieces: DataFrame, length: int = LENGTH, bound: int = OPEN, task_tokens: int = TASK_TOKENS
) -> DataFrame:
    """``pieces`` (with ``length``) with the sequence each is in and its place there.

    ``pieces`` is a stored table.  Pieces are dealt at random by their values and
    met in an order that depends on their values alone, so a task that is run
    again packs the same way.  They come in rounds of about ``ROUND``, the long
    ones of a round first, so that its short ones fill what the long ones left.
    Each task closes its own sequences: with about ``task_tokens`` tokens each,
    the open ones at its end weigh little.
    """
    total, count = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, total // task_tokens)
    rounds = max(1, count // (tasks * ROUND))
    order = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(11))
    dealt = pieces.withColumn("__order", order)
    placed = dealt.repartition(tasks, F.xxhash64("__order", F.lit(13))).sortWithinPartitions(
        F.pmod(F.xxhash64("__order", F.lit(17)), F.lit(rounds)),
        F.col("length").desc(), "__order", "doc_id", "piece",
    )
    schema = f"{_PIECES}, sequence_id long, offset long"
    return placed.drop("__order").mapInArrow(_packing(length, bound), schema)


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    bound: int = OPEN,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every document.

    * A NULL or empty text is its end id alone, a piece of one token.
    * Repeated rows are packed each.
    * A NULL doc_id is packed like any other.
    * An empty table gives an empty result; other columns are not looked at.
    """
    path = path or public_tokenizer("word_bpe_49k.json")
    pieces = stored(token_pieces(docs, path, length, end_id), "pieces")
    return pack_pieces(pieces, length, bound)
