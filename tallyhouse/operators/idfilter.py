"""A filter of ids that is small enough to be broadcast, whatever number of ids it stands for.

It is a bitmap in blocks of 4,096 bits.  An id belongs to one block and sets four of its bits, all
by its hash, so asking for an id is a join with one block and four bit tests.  Ids that were put
in are always found.  Others are found by chance: with 16 bits an id, about one in three hundred.
The bitmap grows with the ids up to a fixed size, which bounds the broadcast at every scale;
beyond it only the share of chance hits grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the largest bitmap: a broadcast of 64 MB and its row headers.
MAX_BITS = 1 << 29
BITS_PER_ID = 16
BLOCK_BITS = 4096

_WORD_BITS = 64
_PROBES = 4


def bitmap_bits(ids: int, max_bits: int = MAX_BITS) -> int:
    """Bits for so many ids: a power of two, at least one block and at most ``max_bits``."""
    wanted = 1 << max(ids * BITS_PER_ID - 1, 1).bit_length()
    return max(BLOCK_BITS, min(wanted, max_bits))


def _block(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(bits // BLOCK_BITS).cast("long"))


def _places(key: Column) -> list[Column]:
    spread = F.xxhash64(F.lit(13), key)
    step = BLOCK_BITS.bit_length() - 1
    return [
        F.shiftright(spread, step * probe).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
        for probe in range(_PROBES)
    ]


@dataclass(frozen=True)
class IdFilter:
    """Blocks (``_block``, ``_words``) of a bitmap of ``bits`` bits."""

    blocks: DataFrame
    bits: int

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """``rows`` that may be among the ids, and the rows that are not.

        Neither side moves rows: the blocks are broadcast.  Rows must have a ``key``.
        """
        block = _block(F.col(key), self.bits)
        asked = rows.join(F.broadcast(self.blocks), block == F.col("_block"), "left")
        hit = F.lit(True)
        for place in _places(F.col(key)):
            word = F.get("_words", F.floor(place / _WORD_BITS).cast("int"))
            hit = hit & (F.getbit(word, place % _WORD_BITS) == 1)
        hit = F.coalesce(hit, F.lit(False))
        return asked.filter(hit).select(*rows.columns), asked.filter(~hit).select(*rows.columns)

    def maybe(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` that may be among the ids."""
        return self.split(rows, key)[0]


def id_filter(ids: DataFrame, n: int, key: str = "id", max_bits: int = MAX_BITS) -> IdFilter:
    """The filter of the ``n`` ids of a table.

    Bits are combined before they are moved; a block is one row at the end.
    """
    bits = bitmap_bits(n, max_bits)
    places = ids.select(
        _block(F.col(key), bits).alias("_block"), F.explode(F.array(*_places(F.col(key)))).alias("place")
    )
    words = places.groupBy("_block", F.floor(F.col("place") / _WORD_BITS).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, place % {_WORD_BITS})")).alias("bits")
    )
    listed = words.groupBy("_block").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("set")
    )

    def after_gap(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get("set", i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), x["word"] - before - 1), F.array(x["bits"]))

    blocks = listed.select("_block", F.flatten(F.transform("set", after_gap)).alias("_words"))
    return IdFilter(blocks, bits)


__all__: Sequence[str] = ["BITS_PER_ID", "MAX_BITS", "IdFilter", "bitmap_bits", "id_filter"]
