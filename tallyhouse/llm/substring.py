"""Repeated passages across documents, found level by level.

Windows of a short length that occur in no other document cannot be part of a
longer repeated window.  Each level therefore hashes only windows whose two halves
were repeated at the level before, at about twice the length, up to the length asked
for.

Documents are dealt into blocks, and what a block says about its windows travels
as sorted hashes packed by range of the hash (a shard), not as a row per window.
A shard answers each block with those of its hashes that other blocks have
too.  A passage that a third of all documents share is one hash per block, so no
task gets more of it than there are blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import partitions, ship, text_or_empty
from tallyhouse.llm.wordhash import counted, filled, slices, split_words, text_hash, window_hashes

#: Words of the windows asked for.
WINDOW = 13
#: Shortest window of a first level.
SHORTEST = 6
#: Characters of text in a block, on average.
BLOCK_CHARS = 8_000_000


def level_lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths from the first level to ``window``, each at most twice the one before."""
    lengths = [window]
    while -(-lengths[0] // 2) >= shortest:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


# -- messages ----------------------------------------------------------------
# A message holds hashes in ascending order, and beside each the least doc_id
# that has it and whether a second document has it too.

_MESSAGE = "block long, shard long, n long, payload binary"
_COLUMNS = 3
_SCHEMA = pa.schema(
    [("block", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())]
)


def _packed(columns: list[np.ndarray], packer: zstandard.ZstdCompressor) -> bytes:
    """Differences between neighbours, byte place by byte place, compressed."""
    deltas = np.diff(np.stack(columns), prepend=np.zeros((_COLUMNS, 1), np.int64), axis=1)
    planes = deltas.view(np.uint8).reshape(_COLUMNS, -1, 8).transpose(0, 2, 1)
    return packer.compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(payload: bytes, n: int, unpacker: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = unpacker.decompress(payload, max_output_size=8 * n * _COLUMNS)
    planes = np.frombuffer(raw, np.uint8).reshape(_COLUMNS, 8, n).transpose(0, 2, 1)
    deltas = np.ascontiguousarray(planes).reshape(_COLUMNS, 8 * n).view(np.int64)
    return np.cumsum(deltas, axis=1)


def _table(rows: list[tuple]) -> pa.Table:
    columns = [list(c) for c in zip(*rows)] or [[]] * len(_SCHEMA)
    return pa.table(columns, schema=_SCHEMA)


def _to_shards(block: int, shards: int, columns: list[np.ndarray]) -> pa.Table:
    """One message for each shard that has some of a block's hashes."""
    packer = zstandard.ZstdCompressor(level=1)
    if not len(columns[0]):
        return _table([])
    shard = columns[0] // -(-(1 << 63) // shards)
    edges = np.flatnonzero(np.diff(shard, prepend=-1, append=shards))
    return _table(
        [
            (block, int(shard[i]), int(j - i), _packed([c[i:j] for c in columns], packer))
            for i, j in zip(edges[:-1], edges[1:])
        ]
    )


def _messages(table: pa.Table) -> list[np.ndarray]:
    unpacker = zstandard.ZstdDecompressor()
    pairs = zip(table["payload"].to_pylist(), table["n"].to_pylist())
    return [_unpacked(payload, n, unpacker) for payload, n in pairs]


def _answers(table: pa.Table) -> pa.Table:
    """For each block of a shard, those of its hashes that two documents have, here or elsewhere."""
    if not table.num_rows:
        return table
    said = _messages(table)
    hashes, least, several = np.concatenate(said, axis=1)
    block = np.repeat(np.arange(len(said)), [x.shape[1] for x in said])
    order = np.argsort(hashes, kind="stable")
    hashes, least, several, block = (x[order] for x in (hashes, least, several, block))
    first = np.flatnonzero(np.diff(hashes, prepend=-1))
    sizes = np.diff(np.append(first, len(hashes)))
    lowest = np.minimum.reduceat(least, first)
    # Two blocks are two documents, or repeats of one id, which the ids tell in the end.
    repeated = (sizes > 1) | (np.maximum.reduceat(several, first) > 0)
    told = np.repeat(repeated, sizes)
    hashes, lowest, block = hashes[told], np.repeat(lowest, sizes)[told], block[told]
    order = np.argsort(block, kind="stable")
    columns = [hashes[order], lowest[order], np.ones(len(order), np.int64)]
    edges = np.searchsorted(block[order], np.arange(len(said) + 1))
    packer = zstandard.ZstdCompressor(level=1)
    names, shard = table["block"].to_pylist(), table["shard"][0].as_py()
    return _table(
        [
            (names[b], shard, int(j - i), _packed([c[i:j] for c in columns], packer))
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:]))
            if j > i
        ]
    )


# -- what a block does -------------------------------------------------------


class _Words:
    """Word hashes of a block's documents; documents without an id take no part."""

    def __init__(self, table: pa.Table):
        # In order of id, so that a stable sort by hash has the least id first.
        table = table.sort_by("doc_id")
        self.table = table
        self.texts = filled(table["text"])
        ids = table["doc_id"].combine_chunks()
        self.known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        hashes, sizes = [], []
        for start, end in slices(self.texts):
            words, starts = split_words(self.texts.slice(start, end - start))
            coded = words.dictionary_encode()
            known = coded.dictionary.to_pylist()
            of_known = np.fromiter(map(text_hash, known), np.uint64, len(known))
            hashes.append(of_known[coded.indices.to_numpy()] if known else of_known)
            sizes.append(np.diff(starts))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def positions(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin, and in which document."""
        numbers = np.where(self.known, np.maximum(self.sizes - length + 1, 0), 0)
        doc = np.repeat(np.arange(len(self.sizes)), numbers)
        return np.repeat(self.starts[:-1], numbers) + counted(numbers), doc

    def windows(self, length: int, at: np.ndarray, bits: int) -> np.ndarray:
        """Hashes below 2^63 of the windows that begin at ``at``, with ``bits`` bits in use."""
        every = window_hashes(self.hashes, length)[at] >> np.uint64(64 - bits)
        return (every << np.uint64(63 - bits)).astype(np.int64)


def _by_hash(hashes: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """Distinct hashes in order, the least id of each, and whether another id has it too.

    ``ids`` must not descend.
    """
    if not len(hashes):
        return [np.empty(0, np.int64)] * 3
    order = np.argsort(hashes, kind="stable")
    hashes, ids = hashes[order], ids[order]
    first = np.flatnonzero(np.diff(hashes, prepend=-1))
    last = np.append(first[1:], len(hashes)) - 1
    return [hashes[first], ids[first], (ids[last] != ids[first]).astype(np.int64)]


def _candidates(words: _Words, levels: list[tuple[int, int]], heard: list[pa.Table]):
    """Windows of the next level whose halves were repeated at each level heard of.

    After the last level, the repeated windows and the least doc_id of each.
    """
    at, doc = words.positions(levels[0][0])
    least = np.empty(0, np.int64)
    for i, answers in enumerate(heard):
        told = _messages(answers)
        if not told:
            return at[:0], doc[:0], least
        known, lowest, _ = np.concatenate(sorted(told, key=lambda x: x[0, 0]), axis=1)
        length, bits = levels[i]
        hashes = words.windows(length, at, bits)
        spot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        repeated = known[spot] == hashes
        at, doc, least = at[repeated], doc[repeated], lowest[spot[repeated]]
        if i + 1 < len(levels) and len(at):
            # A longer window begins where one was repeated and ends where one ends.
            ends = at + levels[i + 1][0] - length
            spot = np.minimum(np.searchsorted(at, ends), len(at) - 1)
            whole = (at[spot] == ends) & (doc[spot] == doc)
            at, doc = at[whole], doc[whole]
    return at, doc, least


def _asking(levels: list[tuple[int, int]], shards: int, last: bool) -> Callable:
    """Messages of a block about its candidates of the last of ``levels``."""
    length, bits = levels[-1]

    def ask(documents: pa.Table, heard: list[pa.Table]) -> pa.Table:
        if not documents.num_rows:
            return _table([])
        words = _Words(documents)
        at, doc, _ = _candidates(words, levels, heard)
        columns = _by_hash(words.windows(length, at, bits), words.ids[doc])
        if not last:
            # Ids are looked at for the windows asked for only.
            columns[1][:] = 0
        return _to_shards(documents["block"][0].as_py(), shards, columns)

    return ask


def _removed_flags(words: _Words, levels: list[tuple[int, int]], heard: list[pa.Table]):
    """Which words lie in a window that also begins in a document with a smaller id."""
    at, doc, least = _candidates(words, levels, heard)
    at = at[least < words.ids[doc]]
    n = len(words.hashes) + 1
    steps = np.bincount(at, minlength=n) - np.bincount(at + levels[-1][0], minlength=n)
    return np.cumsum(steps)[: n - 1] > 0


def _texts_without(words: _Words, removed: np.ndarray) -> Iterator[tuple[list[str], str, int]]:
    """For each document: kept words, text without the removed words, number removed."""
    at = 0
    for i in range(len(words.sizes)):
        size = int(words.sizes[i])
        gone = removed[at : at + size]
        at += size
        text = words.texts[i].as_py()
        kept = text.encode().split() if size else []
        if not gone.any():
            yield kept, text, 0
            continue
        left = [w for w, g in zip(kept, gone) if not g]
        yield left, _cut(text.encode(), kept, gone).decode(), int(gone.sum())


def _cut(text: bytes, words: list[bytes], gone: np.ndarray) -> bytes:
    """The text without the words that are gone and the white space after each of them."""
    parts, place = [], 0
    for word, drop in zip(words, gone):
        start = text.index(word, place)
        end = start + len(word)
        parts.append(text[place:start] if drop else text[place:end])
        while drop and text[end : end + 1].isspace():
            end += 1
        place = end
    parts.append(text[place:])
    return b"".join(parts)


def _reporting(levels: list[tuple[int, int]]) -> Callable:
    def report(documents: pa.Table, heard: list[pa.Table]) -> pa.Table:
        words = _Words(documents)
        removed = _removed_flags(words, levels, heard)
        digests, gone = [], []
        for kept, _, n in _texts_without(words, removed):
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            gone.append(n)
        return pa.table(
            {
                "doc_id": words.table["doc_id"],
                "n_words": pa.array(words.sizes, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    return report


def _rewriting(levels: list[tuple[int, int]]) -> Callable:
    def rewrite(documents: pa.Table, heard: list[pa.Table]) -> pa.Table:
        words = _Words(documents)
        removed = _removed_flags(words, levels, heard)
        texts = [text for _, text, _ in _texts_without(words, removed)]
        return pa.table({"row": words.table["row"], "kept_text": pa.array(texts, pa.string())})

    return rewrite


# -- the job -----------------------------------------------------------------


def _exchange(docs: DataFrame, level_answers: list[DataFrame], body: Callable, schema: str):
    """``body(documents, answers by level)`` of each block."""
    if not level_answers:
        return docs.groupBy("block").applyInArrow(lambda t: body(t, []), schema)
    tagged = None
    for level, answers in enumerate(level_answers):
        part = answers.withColumn("level", F.lit(level))
        tagged = part if tagged is None else tagged.unionAll(part)
    depth = len(level_answers)

    def cogrouped(left: pa.Table, right: pa.Table) -> pa.Table:
        return body(left, [right.filter(pc.equal(right["level"], n)) for n in range(depth)])

    return docs.groupBy("block").cogroup(tagged.groupBy("block")).applyInArrow(cogrouped, schema)


def _deduplicated(docs: DataFrame, columns: list, body: Callable, schema: str, window: int):
    spark = docs.sparkSession
    ship(spark)
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(partitions(spark), -(-total // BLOCK_CHARS))
    # Short windows only choose candidates: as many bits as let about one in
    # thirty pass by chance, whatever the input.  The last level has all of 63.
    few = min(63, max(24, total.bit_length() + 3))
    lengths = level_lengths(window)
    levels = [(n, 63 if n == window else few) for n in lengths]
    dealt = docs.select(
        *columns,
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        # With the text, so that neither rows without an id nor repeats of one id meet.
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
    )
    # One plan for all levels: the texts are dealt out once and each level reads that
    # exchange again.
    answers: list[DataFrame] = []
    for level in range(len(levels)):
        asked = _exchange(dealt, answers, _asking(levels[: level + 1], blocks, lengths[level] == window), _MESSAGE)
        answers.append(asked.groupBy("shard").applyInArrow(_answers, _MESSAGE))
    return _exchange(dealt, answers, body(levels), schema)


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document.

    A word is removed when a window of ``window`` words covers it whose words also
    stand, in order, in a document with a smaller doc_id.  All windows are judged
    on the texts as they come.

    * NULL is the empty text: no words.
    * Rows without a doc_id lose nothing and cost others nothing.
    * Repeated rows have one id, so neither is the earlier one.
    * A text shorter than a window stays whole, an empty table gives an empty result.
    """
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _deduplicated(docs.select("doc_id", "text"), [], _reporting, schema, window)


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words cut out of the texts; other columns as they are.

    White space after a removed word goes with it.  Documents stay, also when
    all their words are gone; ``n_chars`` follows the new text.
    """
    columns = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")]
    thin = docs.select(*columns).schema["row"].dataType.simpleString()
    schema = f"row {thin}, kept_text string"
    done = _deduplicated(docs, columns, _rewriting, schema, window)
    n_chars = F.length("kept_text").cast("long")
    return done.select(
        *[
            F.col("kept_text").alias("text")
            if c == "text"
            else n_chars.alias("n_chars")
            if c == "n_chars"
            else F.col("row")[c].alias(c)
            for c in docs.columns
        ]
    )
