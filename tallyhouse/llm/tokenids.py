"""Token ids in files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0 has the
first chunk of every id, level 1 the second chunk of the ids that go on, and so on.
A bitmap beside each level tells which ids go on, and a directory of counts tells
how many did before each 64 bits, so the place of an id's next chunk is one
look-up and one count of bits away.  Any id is read without decoding
others.

A segment is one such structure with the documents it holds; the file of a token
store is a Parquet table of segments, written and committed by Spark.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import partitions, scratch_path, ship
from tallyhouse.llm.tokens import encoded_batches, public_tokenizer

#: Fixed value: id after each document.
END_ID = 2
CHUNK_BITS = 8
#: Tokens of a segment, about; a document is in one segment.
SEGMENT_TOKENS = 1_000_000
#: Characters of text in one task, about.
TASK_CHARS = 32_000_000

_MAGIC = b"DACS"
_HEAD = struct.Struct("<4sHHqq")
_LEVEL = struct.Struct("<qqqq")

_SEGMENTS = "part long, first_in_part long, n_tokens long, n_docs long, payload binary"


class CodeLevel:
    """Chunks of one level, which of them go on, and counts to find where."""

    def __init__(self, chunks: np.ndarray, words: np.ndarray, directory: np.ndarray):
        self.chunks = chunks
        self.words = words
        self.directory = directory

    @classmethod
    def build(cls, chunks: np.ndarray, more: np.ndarray) -> CodeLevel:
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(bits) // 8) * 8, np.uint8)
        padded[: len(bits)] = bits
        words = padded.view("<u8")
        per_word = np.bitwise_count(words).astype(np.int64)
        return cls(chunks, words, (np.cumsum(per_word) - per_word).astype("<u4"))

    def goes_on(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the chunks before each of ``at`` go on."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.directory[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class DirectCodes:
    """A sequence of ids in which each can be read by itself."""

    def __init__(self, n: int, chunk_bits: int, levels: list[CodeLevel]):
        self.n = n
        self.chunk_bits = chunk_bits
        self.levels = levels

    @classmethod
    def build(cls, ids: np.ndarray, chunk_bits: int = CHUNK_BITS) -> DirectCodes:
        kind = np.dtype("<u1" if chunk_bits <= 8 else "<u2" if chunk_bits <= 16 else "<u4")
        rest, levels = ids.astype(np.uint64), []
        mask = np.uint64((1 << chunk_bits) - 1)
        while True:
            chunks, rest = (rest & mask).astype(kind), rest >> np.uint64(chunk_bits)
            more = rest > 0
            levels.append(CodeLevel.build(chunks, more))
            rest = rest[more]
            if not len(rest):
                return cls(len(ids), chunk_bits, levels)

    def take(self, at: np.ndarray) -> np.ndarray:
        """Ids at any positions, in the order asked for."""
        at = np.asarray(at, np.int64)
        ids = np.zeros(len(at), np.uint32)
        asked = np.arange(len(at))
        for number, level in enumerate(self.levels):
            ids[asked] |= level.chunks[at].astype(np.uint32) << np.uint32(number * self.chunk_bits)
            if number + 1 == len(self.levels):
                break
            more = level.goes_on(at)
            at, asked = level.rank(at[more]), asked[more]
            if not len(at):
                break
        return ids

    def __getitem__(self, at: int) -> int:
        return int(self.take(np.array([at]))[0])


def write_segment(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """Header, documents (id, whether it has one, tokens), then level after level."""
    codes = DirectCodes.build(ids)
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    parts = [
        _HEAD.pack(_MAGIC, codes.chunk_bits, len(codes.levels), len(ids), len(sizes)),
        doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
        known.astype("<u1").tobytes(),
        sizes.astype("<i8").tobytes(),
    ]
    for level in codes.levels:
        arrays = (level.chunks, level.words, level.directory)
        parts.append(_LEVEL.pack(level.chunks.itemsize, *(len(x) for x in arrays)))
        parts += [x.tobytes() for x in arrays]
    return b"".join(parts)


def read_segment(payload: bytes) -> tuple[pa.Array, np.ndarray, DirectCodes]:
    """Document ids, their numbers of tokens, and the codes of a segment."""
    magic, chunk_bits, depth, n, docs = _HEAD.unpack_from(payload)
    if magic != _MAGIC:
        raise ValueError("not a segment of directly addressable codes")
    place = _HEAD.size

    def array(kind: str, count: int) -> np.ndarray:
        nonlocal place
        values = np.frombuffer(payload, kind, count, place)
        place += values.nbytes
        return values

    ids, known, sizes = array("<i8", docs), array("<u1", docs), array("<i8", docs)
    levels = []
    for _ in range(depth):
        width, *counts = _LEVEL.unpack_from(payload, place)
        place += _LEVEL.size
        kinds = (f"<u{width}", "<u8", "<u4")
        levels.append(CodeLevel(*(array(k, c) for k, c in zip(kinds, counts))))
    return pa.array(ids, mask=known == 0), sizes, DirectCodes(n, chunk_bits, levels)


def _encoding(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple[pa.Array, list[np.ndarray]]] = []
        waiting = first = 0

        def segment() -> pa.RecordBatch:
            ids = [x for _, lists in held for x in lists]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            payload = write_segment(
                pa.concat_arrays([d for d, _ in held]), sizes, np.concatenate(ids)
            )
            columns = [[part], [first], [int(sizes.sum())], [len(ids)], [payload]]
            kinds = [pa.int64()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["part", "first_in_part", "n_tokens", "n_docs", "payload"],
            )

        for batch, ids in encoded_batches(batches, path, keeps_space=True, end_id=end_id):
            if not ids:
                continue
            held.append((batch["doc_id"], ids))
            waiting += sum(map(len, ids))
            if waiting >= SEGMENT_TOKENS:
                yield segment()
                held, waiting, first = [], 0, first + waiting
        if held:
            yield segment()

    return encode


def write_tokens(docs: DataFrame, target: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents, in ascending order of doc_id, as a token store.

    Texts are dealt by ranges of doc_id and encoded where they arrive, so ids are
    never moved.  Rows without a doc_id come first; repeated ids are ordered by text.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(partitions(spark), -(-total // TASK_CHARS))
    ordered = rows.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(_encoding(path, end_id), _SEGMENTS)
    segments.write.option("compression", "zstd").parquet(target)


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            doc_ids, sizes, codes = read_segment(row["payload"])
            ends = np.cumsum(sizes)
            ids = codes.take(np.arange(codes.n)).astype("<u4", copy=False)
            crcs = [
                zlib.crc32(ids[end - size : end]) for end, size in zip(ends.tolist(), sizes.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids,
                    pa.array(row["first"] + ends - sizes),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, source: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of a token store.

    A segment knows where it begins in its part; where a part begins follows from
    the sizes of those before it, one row for each task that wrote.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(source)
    parts = segments.groupBy(F.col("part").alias("of_part")).agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select(
        "of_part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_first")
    )
    located = segments.join(F.broadcast(placed), F.expr("part = of_part"))
    first = (F.col("part_first") + F.col("first_in_part")).alias("first")
    return located.select(first, "payload").mapInArrow(
        _reading, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_report(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the store of ``docs`` to shared scratch and report what is read back from it.

    * NULL and empty texts have the end id alone.
    * Rows without a doc_id come first and are reported without one.
    * An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    target = scratch_path(spark, "llm-tokens")
    write_tokens(docs, target, path or public_tokenizer("byte_bpe_50k.json"), end_id)
    return read_tokens(spark, target)
