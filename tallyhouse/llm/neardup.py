"""Near-duplicate documents: ProbMinHash signatures, banding, verification, classes.

A text is the weighted set of its five-word shingles; a shingle found ``c`` times
weighs ``1 + ln c``.  Each shingle is the source of a Poisson process with its
weight as rate, each arrival falls into a register at random, and a register
keeps the shingle that arrives first.  Two texts agree in a register with the
probability of their probability Jaccard similarity.  A text with repeated shingles has
a second row of registers with all weights 1, which agree with the probability of
plain Jaccard similarity; for other texts the two rows are the same.

Registers are banded; texts that share a band are candidates; a candidate pair is
a link when its exact similarity reaches the threshold.  Classes are the connected
components of all links between distinct texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship, small, stored, text_or_empty
from tallyhouse.llm.wordhash import counted, filled, mixed, slices, window_hashes, word_hashes


@dataclass(frozen=True)
class Banding:
    """A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands.

    This holds for either similarity, plain or probability Jaccard.  That is 0.9997 at 0.8 and above, and 0.03 at 0.3.
    """

    bands: int = 20
    rows: int = 5
    words: int = 5
    similarity: float = 0.8


#: Bits of a shingle's identity; the rest of 64 bits numbers the texts of a slice.
_ID_BITS = 51
_SLICE_TEXTS = 1024


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, shingle, count, in order of both.

    A text of fewer words than a shingle has is one shingle, one without words none.
    """
    hashes, starts = word_hashes(texts)
    sizes = np.diff(starts)
    numbers = np.maximum(sizes - words + 1, 0)
    at = np.repeat(starts[:-1], numbers) + counted(numbers)
    windows = window_hashes(hashes, words)
    owner, shingle = [np.repeat(np.arange(len(sizes)), numbers)], [windows[at]]
    for n in range(1, words):
        short = np.flatnonzero(sizes == n)
        if len(short):
            owner.append(short)
            shingle.append(window_hashes(hashes, n)[starts[short]])
    keys = np.concatenate(owner).astype(np.uint64) << np.uint64(_ID_BITS)
    keys |= np.concatenate(shingle) >> np.uint64(64 - _ID_BITS)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    counts = np.diff(np.append(first, len(keys))).astype(np.int64)
    distinct = keys[first] if len(keys) else keys
    mask = np.uint64((1 << _ID_BITS) - 1)
    return (distinct >> np.uint64(_ID_BITS)).astype(np.int64), distinct & mask, counts


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def registers(
    owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, size: int
) -> np.ndarray:
    """ProbMinHash: a row of ``size`` shingle ids for each text.

    Arrivals are made up to a time at which all registers of a text are likely to
    be taken, which ends the work early: only shingles that arrive by then have
    a second arrival drawn, and so on.  Texts with a free register are done again up
    to twice that time, so the outcome never depends on the first guess.  A text
    without shingles has zeros.
    """
    result = np.zeros((texts, size), np.uint64)
    totals = np.bincount(owner, weight, texts)
    horizon = size * (np.log(size) + 5) / np.where(totals > 0, totals, 1)
    pending = totals > 0
    while pending.any():
        live = pending[owner]
        who, what, rate = owner[live], shingle[live], weight[live]
        when = np.zeros(len(who))
        best = np.full(texts * size, np.inf)
        seen = []
        turn = 0
        while len(who):
            turn += 1
            bits = mixed(what + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
            when = when - np.log(_unit(bits)) / rate
            early = when <= horizon[who]
            who, what, rate, when, bits = (x[early] for x in (who, what, rate, when, bits))
            spot = mixed(bits ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)
            slot = who * size + spot.astype(np.int64)
            np.minimum.at(best, slot, when)
            seen.append((slot, when, what))
        slot, when, what = (np.concatenate(x) for x in zip(*seen))
        full = np.isfinite(best.reshape(texts, size)).all(axis=1) & pending
        wins = (when == best[slot]) & full[slot // size]
        result.reshape(-1)[slot[wins]] = what[wins]
        pending &= ~full
        horizon[pending] *= 2
    return result


def weights_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def _band_keys(signature: np.ndarray, banding: Banding) -> np.ndarray:
    """One key per text and band; bands have different keys for the same rows."""
    split = signature.reshape(len(signature), banding.bands, banding.rows)
    keys = np.broadcast_to(np.arange(1, banding.bands + 1, dtype=np.uint64), split.shape[:2])
    for row in range(banding.rows):
        keys = mixed(keys * np.uint64(0xC2B2AE3D27D4EB4F) + split[:, :, row])
    return keys


def _bands_of_texts(texts: pa.Array, banding: Banding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys of all texts in order, where each text's begin (with the end), and whether
    it has words.

    A text's keys are those of its weighted registers and, where shingles are repeated, those
    of its plain ones, in the same bands: a plain set is found by either kind of text.
    """
    owner, shingle, counts = shingle_sets(texts, banding.words)
    size = banding.bands * banding.rows
    weighted = _band_keys(registers(owner, shingle, weights_of(counts), len(texts), size), banding)
    keys = np.concatenate([weighted, weighted], axis=1)
    repeats = np.bincount(owner, counts > 1, len(texts)) > 0
    if repeats.any():
        live = repeats[owner]
        number = np.cumsum(repeats) - 1
        ones = np.ones(int(live.sum()))
        plain = registers(number[owner[live]], shingle[live], ones, int(repeats.sum()), size)
        keys[repeats, banding.bands :] = _band_keys(plain, banding)
    wanted = np.ones(keys.shape, bool)
    # Keys of different bands differ, so a key comes twice in its own band only.
    wanted[:, banding.bands :] = keys[:, banding.bands :] != weighted
    starts = np.concatenate([[0], np.cumsum(wanted.sum(axis=1))])
    return keys[wanted], starts, np.bincount(owner, minlength=len(texts)) > 0


def _signing(banding: Banding):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = filled(batch["text"])
            for start, end in _text_slices(whole):
                texts = whole.slice(start, end - start)
                keys, starts, has_words = _bands_of_texts(texts, banding)
                keys, offsets = keys.view(np.int64), starts.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, end - start),
                        batch["node"].slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                        pa.array(has_words),
                    ],
                    names=["doc_id", "node", "bands", "has_words"],
                )

    return sign


def _text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    for start, end in slices(texts):
        for at in range(start, end, _SLICE_TEXTS):
            yield at, min(at + _SLICE_TEXTS, end)


#: Node of the graph: a distinct text.
def _node(text: Column) -> Column:
    return F.md5(text)


def signatures(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, node, bands, has_words) of each document: digest of the text and band keys."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _node(text_or_empty()).alias("node"),
        text_or_empty().alias("text"),
    )
    return rows.mapInArrow(
        _signing(banding), "doc_id long, node string, bands array<long>, has_words boolean"
    )


# ---------------------------------------------------------------------------
# Exact similarity of candidate pairs
# ---------------------------------------------------------------------------


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Sum over i of 1 / sum over j of max(x_j / x_i, y_j / y_i), for weights side by side.

    With the elements in order of x/y, the inner sum takes x from those at or
    above i and y from those below, so running totals give all of them.
    """
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    below = np.concatenate([[0.0], np.cumsum(y)])
    above = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio, ratio[both])
    return float(np.sum(x[both] / (above[at] + ratio[both] * below[at])))


def linked(
    sets: list[tuple[np.ndarray, np.ndarray]], least: float, left: int | None = None
) -> list[tuple[int, int]]:
    """Pairs of counted shingle sets whose similarity is ``least`` or more, by either measure.

    With ``left`` only pairs of one of the first ``left`` sets and one of the others.
    Sizes of intersections are products of 0-1 matrices, made over so many shared
    shingles at a time.  The probability Jaccard similarity is at most the weight
    that either text has in common with the other, so it is worked out only where
    repeated shingles make it differ and that bound reaches ``least``.
    """
    n = len(sets)
    rows, columns = (slice(0, n), slice(0, n)) if left is None else (slice(0, left), slice(left, n))
    sizes = np.array([len(ids) for ids, _ in sets])
    owner = np.repeat(np.arange(n), sizes)
    weight = weights_of(np.concatenate([counts for _, counts in sets]))
    repeats = np.bincount(owner, weight > 1, n) > 0
    totals = np.bincount(owner, weight, n)
    _, number, found = np.unique(
        np.concatenate([ids for ids, _ in sets]), return_inverse=True, return_counts=True
    )
    shared = found[number] > 1
    owner, number, weight = owner[shared], number[shared], weight[shared]
    order = np.argsort(number, kind="stable")
    owner, number, weight = owner[order], number[order], weight[order]
    column = np.cumsum(np.diff(number, prepend=-1) > 0) - 1
    common = np.zeros((n, n))[rows, columns]
    held, holds = common.copy(), common.copy()
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [start, start + width]))
        has = np.zeros((n, width), np.float32)
        has[owner[part], column[part] - start] = 1
        common += has[rows] @ has[columns].T
        if repeats.any():
            weighs = np.zeros((n, width), np.float32)
            weighs[owner[part], column[part] - start] = weight[part]
            held += weighs[rows] @ has[columns].T
            holds += has[rows] @ weighs[columns].T
    union = sizes[rows, None] + sizes[None, columns] - common
    alike = common >= (least - 1e-9) * union
    if repeats.any():
        bound = np.minimum(held / totals[rows, None], holds / totals[None, columns])
        open_ = (repeats[rows, None] | repeats[None, columns]) & ~alike & (bound >= least - 1e-6)
        for i, j in np.argwhere(open_):
            a, b = sets[i], sets[j + (left or 0)]
            everything = np.union1d(a[0], b[0])
            x, y = np.zeros(len(everything)), np.zeros(len(everything))
            x[np.searchsorted(everything, a[0])] = weights_of(a[1])
            y[np.searchsorted(everything, b[0])] = weights_of(b[1])
            alike[i, j] = probability_jaccard(x, y) >= least - 1e-9
    pairs = np.argwhere(alike)
    pairs[:, 1] += left or 0
    return [(i, j) for i, j in pairs.tolist() if i != j]


def _forest(names: list[str], pairs: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """As few links as connect what ``pairs`` connect."""
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        root[find(i)] = find(j)
    tied = ((names[find(i)], names[i]) for i in range(len(names)))
    return sorted({(a, b) for a, b in tied if a != b})


def _sets_of_texts(banding: Banding):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = filled(batch["text"])
            for start, end in _text_slices(whole):
                owner, shingle, counts = shingle_sets(whole.slice(start, end - start), banding.words)
                ends = np.searchsorted(owner, np.arange(end - start + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["node"].slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(shingle.view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int32))),
                    ],
                    names=["node", "shingles", "counts"],
                )

    return sets


def _block_links(keys: tuple[str, ...], least: float):
    """Links within each block of rows that arrive together.

    Rows with ``first`` set are held against the others, in a block without such
    rows all are held against all.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> pa.RecordBatch:
            held.sort(key=lambda r: not r["first"])
            left = sum(r["first"] for r in held) or None
            sets = [(r["shingles"], r["counts"]) for r in held]
            names = [r["node"] for r in held]
            found = _forest(names, linked(sets, least, left)) if len(held) > (left or 0) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            flat = {c: batch[c].to_pylist() for c in (*keys, "node", "first")}
            arrays = {
                c: (batch[c].offsets.to_numpy(), batch[c].values.to_numpy(zero_copy_only=False))
                for c in ("shingles", "counts")
            }
            for i in range(batch.num_rows):
                row = {c: v[i] for c, v in flat.items()}
                row |= {c: v[o[i] : o[i + 1]].copy() for c, (o, v) in arrays.items()}
                if held and any(held[0][k] != row[k] for k in keys):
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return links


def _links_in_blocks(rows: DataFrame, sets: DataFrame, keys: tuple[str, ...], least: float) -> DataFrame:
    """(a, b) from rows (keys, node, first), a block for each value of ``keys``."""
    placed = rows.join(sets, "node").repartition(*keys).sortWithinPartitions(*keys, "node")
    return placed.mapInArrow(_block_links(keys, least), "a string, b string")


# ---------------------------------------------------------------------------
# Classes
# ---------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the least node it is connected to.

    Labels go to neighbours and then from a label's own label to its bearers, which
    doubles the reach of each round.  Each round is a stored table.
    """
    both = stored(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels"
    )
    while True:
        heard = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a").agg(F.min("label").alias("heard"))
        )
        told = labels.join(heard, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        # A label is a node that has a label in turn.
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        moved = stored(
            told.join(jump, F.col("label") == F.col("via"), "left").select(
                "node", "old", F.least("label", "further").alias("label")
            ),
            "labels",
        )
        if moved.filter("old <> label").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


#: Texts and shingles of a block.
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 1_000_000


def _blocks_of(texts: Column, shingles: Column) -> Column:
    """How many blocks a group is dealt into."""
    return F.greatest(F.ceil(texts / BLOCK_TEXTS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1))


def text_classes(members: DataFrame, sets: DataFrame, banding: Banding) -> DataFrame:
    """(node, label) of the nodes in ``members`` (bucket, node).

    Texts that share buckets, directly or by way of others, are a group; a group is
    dealt into blocks.  First the texts of a block are held against one another and
    against the group's centre, the text that shares most buckets, which is the
    likeliest original of a group of copies.  Then texts that are not of the centre's
    class are held against all other blocks, a block of them at a time.  So every pair
    of a group that is not known to be of one class is looked at, pairs are never
    rows, and a group of copies of one original takes time in proportion to its size.
    """
    sizes = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")
    )
    sized = stored(members.join(sizes, "bucket"), "sized-buckets")
    chained = sized.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    groups = components(chained.distinct()).withColumnRenamed("label", "group")
    degrees = sized.groupBy("node").agg(F.sum("size").alias("degree"))
    volumes = sets.select("node", F.size("shingles").alias("volume"))
    nodes = stored(groups.join(degrees, "node").join(volumes, "node"), "grouped")
    whole = stored(
        nodes.groupBy("group").agg(
            _blocks_of(F.count(F.lit(1)), F.sum("volume")).alias("blocks"),
            F.max_by("node", F.struct("degree", "node")).alias("centre"),
        ),
        "groups",
    )
    placed = stored(
        nodes.join(small(whole, 160), "group").withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks"))
        ),
        "placed",
    )
    numbers = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    centres = (
        placed.filter("node = centre")
        .select("group", "node", F.col("block").alias("own"), F.explode(numbers).alias("block"))
        .filter("block <> own")
    )
    first = F.lit(False).alias("first")
    together = placed.select("group", "block", "node", first).unionAll(
        centres.select("group", "block", "node", first)
    )
    links = stored(_links_in_blocks(together, sets, ("group", "block"), banding.similarity), "links")

    def labeled(links: DataFrame) -> DataFrame:
        known = components(links)
        named = placed.join(known, "node", "left")
        return stored(named.withColumn("label", F.coalesce("label", "node")), "labeled")

    labels = labeled(links)
    central = labels.filter("node = centre AND blocks > 1").select("group", F.col("label").alias("main"))
    apart = labels.join(small(stored(central, "main-classes"), 160), "group").filter("label <> main")
    apart = stored(apart.select("group", "node", "volume", "blocks"), "apart")
    if apart.isEmpty():
        return labels.select("node", "label")
    dealt = apart.groupBy("group").agg(
        _blocks_of(F.count(F.lit(1)), F.sum("volume")).alias("parts")
    )
    dealt = small(stored(dealt, "parts"), 128)
    ones = apart.join(dealt, "group").select(
        "group", "node", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).alias("part"),
        F.explode(numbers).alias("block"), F.lit(True).alias("first"),
    )
    parts = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    others = placed.join(dealt, "group").select(
        "group", "node", F.explode(parts).alias("part"), "block", first
    )
    crossing = _links_in_blocks(
        ones.unionByName(others), sets, ("group", "part", "block"), banding.similarity
    )
    return labeled(stored(links.unionAll(crossing), "all-links")).select("node", "label")


def classified(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, node, class_id), one row per row of ``docs``, stored.

    * ``class_id`` is the least doc_id of the class, NULL only when all are NULL.
    * NULL is the empty text; all texts without words are of one class.
    * A text of fewer than five words is one shingle: equal words make it equal.
    * Repeated rows and exact copies are one node of the graph.
    * An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    signed = stored(signatures(docs, banding), "signatures")
    texts = signed.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("kept"),
        F.any_value("bands").alias("bands"),
        F.any_value("has_words").alias("has_words"),
    )
    texts = stored(
        texts.select("node", F.col("kept.doc_id").alias("kept_id"), "bands", "has_words"), "texts"
    )
    banded = texts.filter("has_words").select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(banded.join(shared, "bucket").select("bucket", "node"), "buckets")
    wanted = stored(
        members.select("node").distinct().join(texts.select("node", "kept_id"), "node"), "wanted"
    )
    found = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _node(text_or_empty()).alias("digest"),
            text_or_empty().alias("text"),
        )
        .join(
            small(wanted, 128), F.expr("digest = node AND doc_id <=> kept_id")
        )
        .select("node", "text")
    )
    # A repeated row would come twice; its shingles are the same.
    sets = stored(
        found.mapInArrow(
            _sets_of_texts(banding), "node string, shingles array<long>, counts array<int>"
        ).dropDuplicates(["node"]),
        "shingles",
    )
    labels = text_classes(members, sets, banding)
    wordless = texts.filter("NOT has_words").select("node", F.lit("no words").alias("label"))
    named = texts.select("node", "kept_id").join(labels.unionAll(wordless), "node", "left").select(
        "node", "kept_id", F.coalesce("label", "node").alias("label")
    )
    ids = named.groupBy("label").agg(F.min("kept_id").alias("class_id"))
    classes = stored(named.join(ids, "label").select("node", "class_id"), "class-ids")
    return stored(signed.select("doc_id", "node").join(classes, "node"), "classified")


def class_report(docs: DataFrame) -> DataFrame:
    """Per document: the id of its class, and whether it is the one that stays."""
    return classified(docs).select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept")
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the least doc_id of each class, in the columns of ``docs``.

    Rows without a doc_id and repeated rows stay once per text.
    """
    kept = classified(docs).filter("doc_id <=> class_id").select("doc_id", "node")
    single = stored(kept.distinct(), "kept")
    repeated = kept.count() > single.count()
    keys = single.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))
    marked = docs.withColumn("__text", _node(text_or_empty()))
    rows = marked.join(keys, F.expr("__text = __node AND doc_id <=> __id"), "left_semi")
    if repeated:
        rows = rows.dropDuplicates(["doc_id", "__text"])
    return rows.drop("__text")
