"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that is to grow or shrink by the factor ``p`` is taken
``floor(p)`` times and once more with the probability of the fraction.  The
fractions are rounded in pairs: words move from one document's expectation to
the other's, at random and without bias, until one of the two is decided.  What
a source takes in words is the same before and after each such step, so its total
misses the target by less than the one document decided last.

What is rounded are hashes and sizes, never texts.  Equal rows have one expectation
and cannot be told apart, so they are one item: as many of them are taken once more
as their number times the fraction says, and what is left of that is rounded
with the others.  Groups of items are rounded each in a task, the one undecided item
of each goes on to the next level, and so on up a tree.  Native columns throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import let, small, stored, text_or_empty, uniform, words_of

#: Weights of the sources in order, repeating, and the largest growth.
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3

#: Documents rounded together, and children of a node of the tree.
GROUP = 128
#: Copies of one row that are written together.
_BLOCK = 4096
#: Expectations this close to 0 or 1 are decided.
_EPSILON = 1e-9


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: float = MAX_COPIES,
) -> DataFrame:
    """(source, n, source_size, target) of each source.

    All sizes are shared by weight; a target stops at ``max_copies`` times its
    source and the rest is shared again.  In order of size per weight, with the
    sources before a source stopped, the level ``lam`` of words per weight is the
    largest of the levels so computed.  One row per source: the two windows see
    the list of sources and nothing else.
    """
    stats = sizes.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("source_size")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = stats.withColumn("weight", F.get(listed, (place - 1) % len(weights)))
    cap = max_copies * F.col("source_size").cast("double")
    by_room = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    leveled = weighed.withColumn("level", level)
    lam = F.max("level").over(everything)
    return leveled.select(
        "source", "n", "source_size", F.least(cap, lam * F.col("weight")).alias("target")
    )


def _settle(acc: Column, item: Column) -> Column:
    """One pivotal step between the undecided item of ``acc`` and ``item``."""

    def put(done: Column, it: Column, p: Column) -> Column:
        decided = (p < _EPSILON) | (p > 1 - _EPSILON)
        entry = F.struct(it["k1"].alias("k1"), it["k2"].alias("k2"), (p > 0.5).alias("up"))
        return F.when(decided, F.array_append(done, entry)).otherwise(done)

    def left(it: Column, p: Column) -> Column:
        fields = [it[n].alias(n) for n in ("size", "k1", "k2")]
        undecided = (p >= _EPSILON) & (p <= 1 - _EPSILON)
        return F.when(undecided, F.struct(p.alias("p"), *fields))

    def step(m: Column) -> Column:
        a, b = acc["carry"], item
        raises = m["u"] * (m["up"] + m["down"]) < m["down"]
        moved = F.when(raises, m["up"]).otherwise(-m["down"])
        probs = F.struct(
            (a["p"] + moved / a["size"]).alias("a"), (b["p"] - moved / b["size"]).alias("b")
        )
        return let(
            probs,
            lambda q: F.struct(
                F.coalesce(left(a, q["a"]), left(b, q["b"])).alias("carry"),
                put(put(acc["done"], a, q["a"]), b, q["b"]).alias("done"),
            ),
        )

    a, b = acc["carry"], item
    movable = F.struct(
        F.least((1 - a["p"]) * a["size"], b["p"] * b["size"]).alias("up"),
        F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"]).alias("down"),
        uniform(F.lit(41), a["k1"], b["k1"]).alias("u"),
    )
    first = F.struct(item.alias("carry"), acc["done"].alias("done"))
    return F.when(acc["carry"].isNull(), first).otherwise(let(movable, step))


_ITEM = "struct<p:double,size:double,k1:bigint,k2:bigint>"
_DONE = "array<struct<k1:bigint,k2:bigint,up:boolean>>"


def _round_groups(items: DataFrame) -> DataFrame:
    """(source, node, done, carry) of items (source, node, item), a row per group.

    The largest documents are decided first, so that the undecided one is small.
    """
    ordered = F.array_sort(F.collect_list("item"), _larger_first)
    start = F.struct(F.lit(None).cast(_ITEM).alias("carry"), F.array().cast(_DONE).alias("done"))
    grouped = items.groupBy("source", "node").agg(ordered.alias("items"))
    folded = grouped.select("source", "node", F.aggregate("items", start, _settle).alias("f"))
    return folded.select("source", "node", "f.done", "f.carry")


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def _larger_first(x: Column, y: Column) -> Column:
    order = F.lit(0)
    for name in ("k2", "k1", "size"):
        order = F.when(x[name] > y[name], -1).when(x[name] < y[name], 1).otherwise(order)
    return order


def _hashes(docs: DataFrame) -> list[Column]:
    """128 bits of a whole row, so that only equal rows share them; maps cannot be hashed."""
    values = [F.col(f"`{f.name}`") for f in docs.schema.fields if not _has_map(f.dataType)]
    return [F.xxhash64(F.lit(n), *values).alias(name) for n, name in ((97, "k1"), (101, "k2"))]


def _rounded(open_: DataFrame, widest: int) -> DataFrame:
    """(k1, k2, up) of items (source, n, item), ``n`` being the number of items of the source."""
    nodes = F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP))
    level = open_.select(
        "source", F.pmod(F.xxhash64(F.lit(7), "item.k1"), nodes).alias("node"), "item"
    )
    outcome, width = [], -(-widest // GROUP)
    while True:
        rounded = stored(_round_groups(level), "rounded")
        outcome.append(rounded.select(F.inline("done")))
        level = rounded.filter("carry IS NOT NULL").select(
            "source", F.floor(F.col("node") / GROUP).alias("node"), F.col("carry").alias("item")
        )
        if width <= 1:
            break
        width = -(-width // GROUP)
    last = uniform(F.lit(43), F.col("item.k1")) < F.col("item.p")
    merged = level.select("item.k1", "item.k2", last.alias("up"))
    for part in outcome:
        merged = merged.unionAll(part)
    return merged


def mix_decisions(
    docs: DataFrame,
    size: str = "size",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: float = MAX_COPIES,
) -> DataFrame:
    """(k1, k2, rows, source_size, target, base, extra) of each distinct row, stored.

    ``rows`` rows are equal; each is taken ``base`` times and ``extra`` of them once more.
    Only hashes and sizes are moved, equal rows combined before.
    """
    amount = F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("size")
    narrow = docs.select(*_hashes(docs), F.col(f"`{source}`").alias("source"), amount)
    alike = stored(
        narrow.groupBy("k1", "k2", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "alike"
    )
    targets = stored(
        source_targets(
            alike.select("source", (F.col("size") * F.col("rows")).alias("size")),
            weights=weights,
            max_copies=max_copies,
        ),
        "source-targets",
    )
    widest = targets.agg(F.max("n")).first()[0] or 0
    share = F.least(F.lit(float(max_copies)), F.col("target") / F.col("source_size"))
    joined = alike.join(
        small(targets.withColumnRenamed("source", "t_source"), 256),
        F.expr("source <=> t_source"),
    ).withColumn("p", F.when(F.col("source_size") > 0, share).otherwise(F.lit(0.0)))
    # A fraction that is all rounding error counts as decided.
    based = joined.withColumn("base", F.floor(F.col("p") + _EPSILON))
    more = F.greatest(F.col("p") - F.col("base"), F.lit(0.0)) * F.col("rows")
    whole = F.floor(more + _EPSILON)
    # The rest of an expectation is lost for rows without words only.
    split = based.withColumn("whole", whole).withColumn(
        "rest", F.when(F.col("size") > 0, F.greatest(more - whole, F.lit(0.0))).otherwise(F.lit(0.0))
    )
    item = F.struct(
        F.col("rest").alias("p"), F.col("size").cast("double").alias("size"), "k1", "k2"
    )
    open_ = split.filter(F.col("rest") >= _EPSILON).select("source", "n", item.alias("item"))
    ups = _rounded(open_, widest).filter("up").select("k1", "k2", F.lit(1).alias("up"))
    decided = split.join(ups, ["k1", "k2"], "left")
    extra = F.least(F.col("rows"), F.col("whole") + F.coalesce("up", F.lit(0)))
    return stored(
        decided.select(
            "k1", "k2", "rows", "source_size", "target", F.col("base").cast("long").alias("base"),
            extra.cast("long").alias("extra"),
        ),
        "mix-decisions",
    )


def _repeated(rows: DataFrame, times: Column, most: int) -> DataFrame:
    """Each of ``rows`` ``times`` over, with its number ``turn`` from 0.

    A row with many copies is dealt out in blocks of them, which several tasks write.
    """
    counted = rows.withColumn("times", times).filter("times > 0")
    turns = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + _BLOCK, F.col("times")) - 1))
    begun = counted.withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(_BLOCK).cast("long")))
    )
    if most > _BLOCK:
        begun = begun.repartition("k1", "k2", "from")
    return begun.withColumn("turn", turns).drop("times", "from")


def _decided_rows(docs: DataFrame, decisions: DataFrame) -> tuple[DataFrame, int]:
    """(row, rows, source_size, target, base, extra) of each distinct row, and the most rows alike.

    Where no two rows are equal, the decisions are joined to the rows as they are.
    """
    most = decisions.agg(F.max("rows")).first()[0] or 0
    keyed = docs.select(F.struct("*").alias("row"), *_hashes(docs))
    if most > 1:
        # Equal rows are combined before they are moved.
        keyed = keyed.groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return keyed.join(small(decisions, 96), ["k1", "k2"]), most


def mix_sources(
    docs: DataFrame,
    size: str = "size",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: float = MAX_COPIES,
) -> DataFrame:
    """(row, source_size, target, copies): each row of ``docs`` and how often it is taken.

    * ``size`` is a column of ``docs``; NULL counts as 0.
    * No row is taken more than ``max_copies`` times; rows of size 0 are taken
      as often as the expectation says, rounded down.
    * NULL is a source of its own, the last one.
    * The outcome depends on the values of the rows alone, not on their order or
      partitions; equal rows are decided together, however many they are.
    * An empty table gives an empty result; other columns stay in ``row``.
    """
    decisions = mix_decisions(docs, size, source, weights, max_copies)
    rows, most = _decided_rows(docs, decisions)
    each = _repeated(rows, F.col("rows"), most)
    copies = F.col("base") + F.when(F.col("turn") < F.col("extra"), F.lit(1)).otherwise(F.lit(0))
    return each.select("row", "source_size", "target", copies.cast("int").alias("copies"))


def _sized(docs: DataFrame, name: str) -> DataFrame:
    return docs.withColumn(name, F.size(words_of(text_or_empty())).cast("long"))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: its size in words, its source's size and target, and the words taken."""
    sizes = stored(_sized(docs.select("doc_id", "source", "text"), "size").drop("text"), "sizes")
    return mix_sources(sizes).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.size").alias("size"),
        "source_size",
        "target",
        (F.col("row.size") * F.col("copies")).alias("taken"),
    )


def keep_mix(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it.

    Texts are moved once at most, to meet their decisions; see :func:`mix_sources` for
    empty tables, missing values and equal rows.
    """
    sized = _sized(docs, "__size")
    rows, most = _decided_rows(sized, mix_decisions(sized, size="__size"))
    taken = F.col("rows") * F.col("base") + F.col("extra")
    kept = _repeated(rows, taken, most * (MAX_COPIES + 1))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
