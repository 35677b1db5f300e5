"""Document fingerprints: SimHash over word pairs, and search by Hamming radius.

Each distinct pair of neighbouring words hashes to 128 bits and votes on each of the
fingerprint's bits, for or against, with the weight ``1 + ln count``.  Texts of equal words
have equal fingerprints, and the share of equal bits follows the angle between
the weighted texts.

Search cuts a fingerprint into blocks and keeps one table for each, of all fingerprints
permuted so that this block comes first.  Blocks are given numbers of bits to differ in that
together are less than the radius by all but one of the blocks, so two fingerprints within the
radius keep to that number in one block at least, and a table asked for all values so near to
the query's finds the pair.  The more fingerprints there are, the longer are the blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import partitions, ship, small, stored
from tallyhouse.llm.neardup import shingle_sets, weights_of
from tallyhouse.llm.wordhash import filled, mixed

BITS = 128
#: Words of a term.
TERM_WORDS = 2
#: Units that weights are whole numbers of.
WEIGHT_UNIT = 256
#: Differing bits at which two fingerprints still match: texts with 0.8 of their five-word
#: shingles in common differ in 5 to 18 bits on the given documents.
RADIUS = 20
#: Most values that one fingerprint may ask its tables for.
MOST_ASKED = 1_000_000
#: Characters of text in one task, about.
TASK_CHARS = 32_000_000

#: Few enough for their votes to stay in a processor's cache.
_TERMS_AT_ONCE = 2_000
_TEXTS_AT_ONCE = 256
_ASKED_AT_ONCE = 250_000


def fingerprints(texts: pa.Array) -> np.ndarray:
    """One row of two 64-bit numbers for each text; no words give zeros.

    Weights are whole numbers of ``1 / WEIGHT_UNIT``, so votes do not depend on the order of
    the terms or on what other texts are at hand, and equal texts have equal fingerprints.
    """
    owner, term, counts = shingle_sets(texts, TERM_WORDS)
    weight = np.rint(WEIGHT_UNIT * weights_of(counts)).astype(np.int32)
    total = np.zeros(len(texts), np.int64)
    np.add.at(total, owner, weight)
    # Weights of the terms that vote for a bit; the others of the text vote against it.
    votes = np.zeros((len(texts), BITS), np.int64)
    for at in range(0, len(owner), _TERMS_AT_ONCE):
        part = slice(at, at + _TERMS_AT_ONCE)
        halves = np.stack([mixed(term[part]), mixed(term[part] ^ np.uint64(0x5851F42D4C957F2D))], 1)
        bits = np.unpackbits(halves.view(np.uint8), axis=1, bitorder="little")
        cast = np.multiply(bits, weight[part, None], dtype=np.int32)
        first = np.flatnonzero(np.diff(owner[part], prepend=-1))
        votes[owner[part][first]] += np.add.reduceat(cast, first, axis=0)
    packed = np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(len(texts), 2)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of fingerprints side by side."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def _hex(prints: np.ndarray) -> list[str]:
    return [f"{high:016x}{low:016x}" for low, high in prints.tolist()]


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIGURES = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
    "high": pa.int64(),
    "low": pa.int64(),
}
_FIGURES_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, high long, low long"
)


def _figures(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """Columns of ``_FIGURES`` for texts and the texts after them."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    # Neighbours follow one another: the next text is mostly the next row.
    chain = texts + following[-1:]
    shared = all(a is b for a, b in zip(texts[1:], following))
    prints = fingerprints(pa.array(chain if shared else texts, pa.large_string()))
    own = prints[: len(texts)]
    after = prints[1:] if shared else fingerprints(pa.array(following, pa.large_string()))
    other = fingerprints(pa.array(changed, pa.large_string()))
    columns = {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": _hex(own),
        "edited_fingerprint": _hex(other),
        "near_edited": likeness(own, other),
        "near_next": likeness(own, after),
        "high": own[:, 1].view(np.int64),
        "low": own[:, 0].view(np.int64),
    }
    return [pa.array(columns[name], kind) for name, kind in _FIGURES.items()]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of the rows of a partition in order, each with the text after it.

    The last row waits for the next partition: it is returned as it is, together with the
    first text, in the columns part, last_id, last_text and first_text.
    """
    names = [*_FIGURES, "part", "last_id", "last_text", "first_text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    ids: list = []
    texts: list[str] = []
    first = None

    def ready(n: int) -> pa.RecordBatch:
        columns = _figures(ids[:n], texts[:n], texts[1 : n + 1])
        return pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, k) for k in kinds)], names)

    for batch in batches:
        new_texts = filled(batch["text"]).to_pylist()
        ids += batch["doc_id"].to_pylist()
        texts += new_texts
        if first is None and texts:
            first = texts[0]
        while len(texts) > _TEXTS_AT_ONCE:
            yield ready(_TEXTS_AT_ONCE)
            ids, texts = ids[_TEXTS_AT_ONCE:], texts[_TEXTS_AT_ONCE:]
    if texts:
        if len(texts) > 1:
            yield ready(len(texts) - 1)
        own = [TaskContext.get().partitionId(), ids[-1], texts[-1], first]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, k) for k in _FIGURES.values()]
            + [pa.array([v], k) for v, k in zip(own, kinds)],
            names,
        )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            columns = _figures([row["last_id"]], [row["last_text"]], [row["next_text"]])
            yield pa.RecordBatch.from_arrays(columns, list(_FIGURES))


def neighbour_figures(docs: DataFrame) -> DataFrame:
    """Figures of each text, its edited text and the next document's, by ascending doc_id.

    Texts are dealt by ranges of doc_id and sorted there, so all but the last of a
    partition have their neighbour at hand.  Those last rows, one per partition, are
    joined to the first text of the next one; the last of all gets the first of all.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(partitions(docs.sparkSession), -(-total // TASK_CHARS))
    # Rows without an id, and repeats of one, go on by their texts, equal rows by their place.
    order = ["doc_id", "__text", "__place"]
    keyed = rows.withColumns(
        {"__text": F.xxhash64("text"), "__place": F.monotonically_increasing_id()}
    )
    placed = keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = f"{_FIGURES_DDL}, part long, last_id long, last_text string, first_text string"
    chained = stored(
        placed.select("doc_id", "text").mapInArrow(_chained, schema), "fingerprints"
    )
    ends = chained.filter("part IS NOT NULL")
    # Only the numbers of the parts that hold rows come together, one for each task.
    in_order = Window.orderBy("part")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("part").over(in_order), F.first("part").over(whole))
    pairs = ends.select("part").select("part", following.alias("next_part"))
    firsts = ends.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    lasts = ends.select("part", "last_id", "last_text")
    joined = lasts.join(pairs, "part").hint("merge").join(firsts.hint("merge"), "next_part")
    joined = joined.select("last_id", "last_text", "next_text")
    done = joined.mapInArrow(_ends, _FIGURES_DDL)
    return chained.filter("part IS NULL").select(*_FIGURES).unionAll(done)


class Block(NamedTuple):
    """Bits ``at`` to ``at + width`` of a fingerprint, and how many may differ there."""

    at: int
    width: int
    most: int

    @property
    def asked(self) -> int:
        return sum(comb(self.width, n) for n in range(self.most + 1))


def _layout(n_blocks: int, radius: int) -> list[Block]:
    # With sum(most + 1) = radius + 1, no pair within the radius has more than ``most``
    # differing bits in every block.  The shorter blocks take what does not divide.
    width, longer = divmod(BITS, n_blocks)
    spare, more = divmod(radius + 1 - n_blocks, n_blocks)
    blocks, at = [], 0
    for i in range(n_blocks):
        wide = width + (i < longer)
        blocks.append(Block(at, wide, min(wide, spare + (i >= n_blocks - more))))
        at += wide
    return blocks


def block_tables(radius: int, n: int) -> list[Block]:
    """The blocks with the least work for each query of ``n`` fingerprints.

    That is the values asked for and the fingerprints met there by chance.  A block without
    a number of bits to differ in would never be asked, so there are at most radius + 1.
    """
    if not 0 <= radius < BITS:
        raise ValueError(f"a radius is from 0 to {BITS - 1} bits")

    def work(blocks: list[Block]) -> float:
        asked = sum(b.asked for b in blocks)
        met = sum(b.asked / 2.0**b.width for b in blocks)
        return asked + n * met if asked <= MOST_ASKED else float("inf")

    layouts = [_layout(count, radius) for count in range(2, min(16, radius + 1) + 1)]
    # A radius of nothing is equality.
    return min(layouts, key=work) if layouts else [Block(0, 64, 0)]


def _value(block: Block, high: Column, low: Column) -> Column:
    """The block as a number: what stands first in the block's permutation."""
    at, width = block.at, block.width
    if at >= 64:
        value = F.shiftrightunsigned(high, at - 64)
    elif at == 0:
        value = low
    else:
        rest = F.shiftleft(high, 64 - at) if at + width > 64 else F.lit(0).cast("long")
        value = F.shiftrightunsigned(low, at).bitwiseOR(rest)
    return value if width == 64 else value.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


@lru_cache(maxsize=64)
def _changes(width: int, most: int) -> np.ndarray:
    """All changes of at most ``most`` of ``width`` bits."""
    one = [1 << bit for bit in range(width)]
    every = chain.from_iterable(combinations(one, n) for n in range(most + 1))
    return np.fromiter(map(sum, every), np.uint64)


def _asking(blocks: list[Block]):
    names = ["q_high", "q_low", "q_table", "q_key"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = batch["q_high"].to_numpy(), batch["q_low"].to_numpy()
            for table, block in enumerate(blocks):
                changes = _changes(block.width, block.most)
                value = batch[f"block{table}"].to_numpy().view(np.uint64)
                step = max(1, _ASKED_AT_ONCE // len(changes))
                for start in range(0, len(value), step):
                    part = slice(start, start + step)
                    for first in range(0, len(changes), _ASKED_AT_ONCE):
                        some = changes[first : first + _ASKED_AT_ONCE]
                        keys = (value[part, None] ^ some).ravel().view(np.int64)
                        owner = np.repeat(np.arange(len(value))[part], len(some))
                        tables = np.full(len(keys), table, np.int32)
                        columns = [high[owner], low[owner], tables, keys]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(columns, kinds)], names
                        )

    return ask


def find_within_radius(
    queries: DataFrame, prints: DataFrame, radius: int = RADIUS, n: int | None = None
) -> DataFrame:
    """(q_high, q_low, high, low, distance) of all pairs within ``radius`` bits.

    Both inputs have (high, low); repeated fingerprints count once, so a group of
    copies is one entry.  A pair near in several blocks comes out of the first such
    table only, and the distance is checked inside the join, so no pair is made twice
    and no pair beyond the radius is made.  ``n`` is about how many rows ``prints`` has,
    counted where it is not given; results do not depend on it.  Neither side is broadcast.
    """
    blocks = block_tables(radius, prints.count() if n is None else n)
    ship(prints.sparkSession)

    def values(high: str, low: str) -> list[Column]:
        return [_value(block, F.col(high), F.col(low)) for block in blocks]

    asked = queries.select(F.col("high").alias("q_high"), F.col("low").alias("q_low")).distinct()
    fronts = [value.alias(f"block{i}") for i, value in enumerate(values("q_high", "q_low"))]
    left = asked.select("q_high", "q_low", *fronts).mapInArrow(
        _asking(blocks), "q_high long, q_low long, q_table int, q_key long"
    )
    distinct = prints.select("high", "low").distinct()
    right = distinct.select("high", "low", F.posexplode(F.array(*values("high", "low"))))
    apart = [
        F.bit_count(x.bitwiseXOR(y)) for x, y in zip(values("q_high", "q_low"), values("high", "low"))
    ]
    first = F.coalesce(
        *[F.when(gap <= block.most, F.lit(i)) for i, (gap, block) in enumerate(zip(apart, blocks))]
    )
    distance = F.bit_count(F.col("q_high").bitwiseXOR(F.col("high"))) + F.bit_count(
        F.col("q_low").bitwiseXOR(F.col("low"))
    )
    on = (
        (F.col("q_table") == F.col("pos"))
        & (F.col("q_key") == F.col("col"))
        & (distance <= radius)
        & (F.col("pos") == first)
    )
    return left.hint("merge").join(right, on).select(
        "q_high", "q_low", "high", "low", distance.cast("int").alias("distance")
    )


def near_links(asked: DataFrame, figures: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q_high, q_low, high, low, distance): links between classes of equal fingerprints.

    ``asked`` are the query rows and ``figures`` all rows, both with (high, low), which is
    what makes a row a member of its class.  No link is lost, and copies are not expanded
    into pairs.  A class that is asked for is linked to itself at distance 0.
    """
    return find_within_radius(asked, figures, radius)


def _query_classes(asked: DataFrame) -> DataFrame:
    """Rows of each class of query rows, and its two lowest ids."""
    key = [F.col("high").alias("q_high"), F.col("low").alias("q_low")]
    lowest = Window.partitionBy("q_high", "q_low").orderBy("doc_id")
    ranked = asked.select("doc_id", *key).distinct().withColumn("rank", F.row_number().over(lowest))
    ids = ranked.filter("rank <= 2").groupBy("q_high", "q_low").agg(
        F.min("doc_id").alias("first_id"),
        F.max(F.when(F.col("rank") == 2, F.col("doc_id"))).alias("second_id"),
    )
    rows = asked.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(ids, ["q_high", "q_low"])


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The figures of every document, and what the search found for it.

    The query documents are those with an id divisible by 100.  ``near_queries`` counts those
    within the radius, ``nearest_query`` is the nearest (the lowest id of several) and
    ``nearest_distance`` its distance; a document is not among its own.  Every link is in the
    table of :func:`near_links`, which these columns are taken from.

    * NULL is the empty text; texts without words have the fingerprint of zeros.
    * Rows without a doc_id come first; repeated rows follow one another, and a repeated
      query row counts as one more query for its repeats' neighbours, not for the repeats.
    * A single document is followed by itself, an empty table gives an empty result.
    * Columns other than doc_id and text are not looked at.
    """
    figures = stored(neighbour_figures(docs), "fingerprint-figures")
    asked = figures.filter("doc_id % 100 = 0")
    links = stored(near_links(asked, figures, radius), "near-links")
    nearest = F.struct("distance", F.col("first_id").alias("id"))
    own, other = F.col("distance") == 0, F.col("distance") > 0
    found = stored(
        links.join(_query_classes(asked), ["q_high", "q_low"]).groupBy("high", "low").agg(
            F.sum("rows").alias("found_rows"),
            F.max(F.when(own, F.col("first_id"))).alias("own_first"),
            F.max(F.when(own, F.col("second_id"))).alias("own_second"),
            F.min(F.when(other, nearest)).alias("elsewhere"),
        ),
        "near-queries",
    )
    # Repeats of a query row are itself, however many there are.
    repeats = stored(
        asked.groupBy("doc_id", "high", "low").agg(F.count(F.lit(1)).alias("own_rows")),
        "query-rows",
    )
    joined = figures.join(small(found, 80), ["high", "low"], "left").join(
        small(repeats, 48), ["doc_id", "high", "low"], "left"
    )
    itself = F.col("own_rows").isNotNull()
    equal = F.when(itself & (F.col("own_first") == F.col("doc_id")), F.col("own_second")).otherwise(
        F.col("own_first")
    )
    nearest_query = F.coalesce(equal, F.col("elsewhere.id"))
    distance = F.when(equal.isNotNull(), F.lit(0)).otherwise(F.col("elsewhere.distance"))
    count = F.coalesce("found_rows", F.lit(0)) - F.coalesce("own_rows", F.lit(0))
    return joined.select(
        *[c for c in _FIGURES if c not in ("high", "low")],
        count.alias("near_queries"),
        nearest_query.alias("nearest_query"),
        distance.cast("int").alias("nearest_distance"),
    )
