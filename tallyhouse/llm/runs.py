"""Periodic runs of words: maximal repetitions found by catching squares online.

Two equal neighbouring stretches of ``q`` words are a square of period ``q``.  As words are
appended, every completed block of ``2^k`` words (starting at a multiple of ``2^k``) gets a
catcher for the periods from ``2^(k+1) - 1`` to ``2^(k+2) - 2``: the first half of any such
square contains a whole block, which comes again ``q`` words later.  When a word is appended,
exactly two blocks of each size can see their copy end there, so a catcher's work is one
comparison of the text's last ``2^k`` words with each of the two.  A hit reports a place
inside a candidate square; hits of neighbouring blocks at one distance are one chain, the
chain is extended word by word to both sides, and squares of one period that touch merge
into a run.

All words of a batch of texts are appended together: the comparisons of one level are two
passes over an array of window hashes, and the hashes of a level come from those of the level
before.  Hashes only choose candidates.  Every run is compared word by word before it is
returned, so results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import let, ship, text_or_empty, words_of
from tallyhouse.llm.wordhash import filled, slices, split_words

#: Words of the shortest run, and least number of periods in it.
MIN_LENGTH = 6
MIN_EXPONENT = 4

#: Chains that are extended one by one instead of side by side.
_FEW = 8


def _matches(w: np.ndarray, at: np.ndarray, q: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in the direction ``step``, equal the word ``q`` later."""
    n = np.zeros(len(at), np.int64)
    active = np.flatnonzero(room > 0)
    while len(active) > _FEW:
        place = at[active] + step * n[active]
        active = active[w[place] == w[place + q[active]]]
        n[active] += 1
        active = active[n[active] < room[active]]
    for i in active:
        size = 64
        while n[i] < room[i]:
            size = min(2 * size, int(room[i] - n[i]))
            place = at[i] + step * (n[i] + np.arange(size))
            differ = np.flatnonzero(w[place] != w[place + q[i]])
            n[i] += differ[0] if len(differ) else size
            if len(differ):
                break
    return n


class _Known:
    """Runs found so far, to skip catches inside one whose period divides the distance."""

    def __init__(self) -> None:
        self.start = self.end = self.period = np.empty(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        start, end, period = (
            np.concatenate(x)
            for x in ((self.start, start), (self.end, end), (self.period, period))
        )
        order = np.argsort(start, kind="stable")
        self.start, self.end, self.period = start[order], end[order], period[order]
        # Of the runs that begin no later, the one that ends last.
        latest = np.maximum.accumulate(self.end)
        changed = np.concatenate([[True], latest[1:] > latest[:-1]]) if len(latest) else []
        self.reach = np.maximum.accumulate(np.where(changed, np.arange(len(latest)), 0))

    def contain(self, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(len(start), bool)
        spot = np.searchsorted(self.start, start, side="right") - 1
        run = self.reach[np.maximum(spot, 0)]
        return (spot >= 0) & (self.end[run] >= end) & (q % self.period[run] == 0)


def _caught(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all hits of the catchers of level ``k``."""
    size = 1 << k
    nearest = 2 * size - 1
    starts, distances = [], []
    blocks = np.repeat(hashes[::size], size)
    for further in (nearest, nearest + size):
        here = np.flatnonzero(hashes[further:] == blocks[: max(len(hashes) - further, 0)])
        block = (here >> k) << k
        starts.append(block)
        distances.append(here + further - block)
    return np.concatenate(starts), np.concatenate(distances)


def _doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of twice ``size`` words, from those of ``size`` words."""
    if len(hashes) <= size:
        return hashes[:0]
    both = hashes[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[size:]
    both ^= both >> np.uint64(32)
    both *= np.uint64(0xD6E8FEB86659FD93)
    both ^= both >> np.uint64(29)
    return both


def find_runs(
    codes: np.ndarray,
    starts: np.ndarray,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start and period.

    ``codes`` are the words of all texts, equal words having equal codes; text ``i`` is
    ``codes[starts[i]:starts[i + 1]]``.  A run is a stretch of one text with smallest period
    ``q`` and at least ``max(min_length, min_exponent * q)`` words which no neighbouring word
    extends.  ``min_exponent`` is 2 or more.
    """
    if min_exponent < 2:
        raise ValueError(f"a square has two periods, got {min_exponent}")
    sizes = np.diff(starts)
    known = _Known()
    first, level = starts[:-1].astype(np.int64), 0
    w = codes.astype(np.uint64)
    hashes, moved = w, None
    while True:
        size = 1 << level
        nearest = 2 * size - 1
        open_ = sizes >= max(min_length, min_exponent * nearest)
        if not open_.any():
            break
        if 2 * sizes[open_].sum() < len(w):
            # Most words are in texts too short for this level: go on without them.
            kept = np.repeat(open_, sizes)
            w, hashes = w[kept], hashes[kept[: len(hashes)]]
            first, sizes = first[open_], sizes[open_]
            moved = None
        if moved is None:
            begin = np.cumsum(sizes) - sizes
            moved = np.repeat(first - begin, sizes)
            begins, ends = np.repeat(begin, sizes), np.repeat(begin + sizes, sizes)
        s, q = _caught(hashes, level)
        copy = s + q
        inside = (begins[copy] <= s) & (copy + size <= ends[copy])
        s, q = s[inside], q[inside]
        inside = known.contain(s + moved[s], s + moved[s] + q + size, q)
        s, q = s[~inside], q[~inside]
        if len(s):
            order = np.lexsort((s, q))
            s, q = s[order], q[order]
            joined = (q[1:] == q[:-1]) & (s[1:] == s[:-1] + size) & (begins[s[1:]] == begins[s[:-1]])
            head = np.flatnonzero(np.concatenate([[True], ~joined]))
            tail = np.append(head[1:], len(s)) - 1
            left, right, q = s[head], s[tail] + size, q[head]
            least = np.maximum(min_length, min_exponent * q) - q
            long = right - left + 2 * (size - 1) >= least
            left, right, q, least = left[long], right[long], q[long], least[long]
            back = _matches(w, left - 1, q, left - begins[left], -1)
            left = left - back
            right = right + _matches(w, right, q, ends[left] - q - right, 1)
            long = right - left >= least
            found = _compared(w, left[long], right[long], q[long], least[long])
            known.add(found[0] + moved[found[0]], found[1] + moved[found[0]] + found[2], found[2])
        hashes = _doubled(hashes, size)
        level += 1
    return _smallest_periods(known)


def _compared(w: np.ndarray, left, right, q, least) -> tuple[np.ndarray, ...]:
    """Intervals in which every word equals the one ``q`` later; those that do not are split."""
    out = []
    for a, b, p, need in zip(left.tolist(), right.tolist(), q.tolist(), least.tolist()):
        differ = np.flatnonzero(w[a:b] != w[a + p : b + p])
        edges = [-1, *differ.tolist(), b - a]
        out += [(a + i + 1, a + j, p) for i, j in zip(edges, edges[1:]) if j - i - 1 >= need]
    return tuple(np.array(out, np.int64).reshape(-1, 3).T)


def _smallest_periods(known: _Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One run per stretch.  A stretch with several periods has the smallest among them."""
    order = np.lexsort((known.period, known.end, known.start))
    start, end, period = known.start[order], known.end[order], known.period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


# -- texts -------------------------------------------------------------------


def _collapsed(words: pa.Array, starts: np.ndarray, gone: np.ndarray) -> pa.Array:
    kept = np.concatenate([[0], np.cumsum(~gone)])
    offsets = pa.array(kept[starts], pa.int32())
    left = words.filter(pa.array(~gone)).cast(pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, left), " ")


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _of_texts(texts: pa.Array, min_length: int, min_exponent: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each of ``texts``."""
    words, starts = split_words(texts)
    codes = words.dictionary_encode().indices.to_numpy()
    start, length, period = find_runs(codes, starts, min_length, min_exponent)
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    collapsed = _collapsed(words, starts, np.cumsum(gone)[:-1] > 0)
    owner = np.searchsorted(starts, start, side="right") - 1
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    fields = [pa.array(x, pa.int64()) for x in (start - starts[owner], length, period)]
    entries = pa.StructArray.from_arrays(fields, fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
    return [pa.array(np.diff(starts), pa.int64()), runs, collapsed]


def _runs_of(min_length: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch["text"])
            for a, b in slices(texts):
                found = _of_texts(texts.slice(a, b - a), min_length, min_exponent)
                columns = [batch["row"].slice(a, b - a), *found]
                yield pa.RecordBatch.from_arrays(
                    columns, ["row", "n_words", "runs", "collapsed"]
                )

    return run


def periodic_runs(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """The columns ``carry`` of each row, with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are (start, length, period) in words, by start and period; ``collapsed`` is the
    text without the words of a run after its first period, words joined by one space.

    * NULL is the empty text: no words, no runs, an empty collapsed text.
    * Each row is judged alone, so repeated rows get equal results and no rows are moved;
      a long text is one array in one task.
    * An empty table gives an empty result.  Columns not in ``carry`` are not read, whatever
      their names.
    """
    ship(docs.sparkSession)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text")
    )
    kind = packed.schema["row"].dataType.simpleString()
    schema = (
        f"row {kind}, n_words long, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
    found = packed.mapInArrow(_runs_of(min_length, min_exponent), schema)
    return found.select("row.*", "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run of the greatest length per period; of equal ones the first, NULL without runs."""

    def stronger(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), stronger)


def with_repetition(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with one text in ten made periodic, by a rule on its id.

    With ``h`` the crc32 of the id in digits and ``g = h // 10``: when ``h % 10`` is 0, each word
    from ``a = g % n`` on is replaced by word ``a + (i - a) % p``, with
    ``p = 1 + (n - a) // (3 + g % 8)``.  Rows without an id or without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = text_or_empty()

    def periodic(m: Column) -> Column:
        since = m["n"] - m["a"]
        period = 1 + F.floor(since / (3 + m["g"] % 8))

        places = F.sequence(F.lit(0), (m["n"] - 1).cast("int"))
        whole = F.struct(m["words"].alias("words"), m["a"].alias("a"), period.cast("int").alias("p"))
        return let(
            whole,
            lambda x: F.array_join(
                F.transform(
                    places,
                    lambda i: F.get(
                        x["words"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"])
                    ),
                ),
                " ",
            ),
        )

    def measured(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        return F.struct(
            words.alias("words"), n.alias("n"), g.alias("g"), (g % n).cast("int").alias("a")
        )

    changed = let(
        words_of(text),
        lambda words: F.when(F.size(words) == 0, text).otherwise(let(measured(words), periodic)),
    )
    edited = F.when(h % 10 == 0, changed).otherwise(text)
    return docs.select("doc_id", edited.alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """Per document, made periodic by :func:`with_repetition`: figures and digests of its runs.

    Rows without an id are reported as they are; see :func:`periodic_runs` for the rest.
    """
    found = periodic_runs(with_repetition(docs)).withColumn("best", strongest(F.col("runs")))
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
