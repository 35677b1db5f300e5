"""Whitening of embeddings by spectrum slicing.

The covariance of all vectors is summed exactly, in whole numbers, so it does not depend on
how the rows are split.  Its leading eigenvalues are then sliced out one by one: the number of
positive pivots of an LDL' factorization of ``V - s I`` is the number of eigenvalues above
``s``, so a few factorizations bracket each eigenvalue alone; Rayleigh quotient iteration from
the bracket converges cubically; and two more counts certify that the value found is the k-th.

The covariance, ``dimension ** 2`` numbers, is all that reaches the driver.  Sums and the
projection run in tasks over the rows; no row is moved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship

#: Components returned.
COMPONENTS = 32
#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
#: Entries must be below this, so that sums of differences stay whole numbers of 64 bits.
LARGEST = float(2**52)

_ROWS = 4096
_LIMB = 20


# -- eigenvalues -------------------------------------------------------------

_BUNCH_KAUFMAN = (1 + 17**0.5) / 8


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix that are above ``shift``.

    By Sylvester's law of inertia, the positive pivots of ``L D L'`` of the shifted matrix,
    with blocks of one or two pivots chosen so that the factors stay bounded.
    """
    m = matrix - shift * np.eye(len(matrix))
    n, k, above = len(m), 0, 0

    def swap(a: int, b: int) -> None:
        m[[a, b]] = m[[b, a]]
        m[:, [a, b]] = m[:, [b, a]]

    while k < n:
        below = np.abs(m[k + 1 :, k])
        largest = below.max(initial=0.0)
        pair = False
        if abs(m[k, k]) < _BUNCH_KAUFMAN * largest:
            r = k + 1 + int(np.argmax(below))
            row = np.abs(m[r, k:])
            row[r - k] = 0
            across = row.max()
            if abs(m[k, k]) * across < _BUNCH_KAUFMAN * largest**2:
                if abs(m[r, r]) >= _BUNCH_KAUFMAN * across:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    pair = True
        width = 2 if pair else 1
        block, rest = m[k : k + width, k : k + width], m[k + width :, k : k + width]
        if pair:
            above += int((np.linalg.eigvalsh(block) > 0).sum())
            m[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        elif block[0, 0]:
            above += int(block[0, 0] > 0)
            m[k + 1 :, k + 1 :] -= np.outer(rest, rest / block[0, 0])
        k += width
    return above


class _Slices:
    """Counts of eigenvalues above the shifts asked for so far."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        #: Eigenvalues nearer than this are not told apart.
        self.near = 4 * len(matrix) * np.finfo(float).eps * self.norm
        self.counts: dict[float, int] = {
            -self.norm - self.near: len(matrix),
            self.norm + self.near: 0,
        }

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = eigenvalues_above(self.matrix, shift)
        return self.counts[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """The nearest known shifts below and above the k-th largest eigenvalue."""
        low = max(s for s, c in self.counts.items() if c >= k)
        high = min(s for s, c in self.counts.items() if c < k and s > low)
        return low, high

    def halved(self, k: int) -> tuple[float, float]:
        low, high = self.bracket(k)
        self.above((low + high) / 2)
        return self.bracket(k)

    def isolated(self, k: int) -> tuple[float, float]:
        """A bracket with the k-th eigenvalue alone, or one too narrow to part its members."""
        low, high = self.bracket(k)
        while high - low > self.near and (self.above(low), self.above(high)) != (k, k - 1):
            low, high = self.halved(k)
        return low, high

    def certified(self, k: int, value: float) -> bool:
        """Whether the counts on both sides number ``value`` as the k-th."""
        return self.above(value - self.near) >= k and self.above(value + self.near) < k


def _without(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - found.T @ (found @ vector)
    return vector / np.linalg.norm(vector)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, nudge: float) -> np.ndarray:
    for _ in range(8):
        try:
            solved = np.linalg.solve(matrix - shift * np.eye(len(matrix)), vector)
            if np.isfinite(solved).all():
                return solved
        except np.linalg.LinAlgError:
            pass
        shift += nudge
    raise ArithmeticError(f"no solution near the eigenvalue {shift}")


def _rayleigh(
    slices: _Slices, low: float, high: float, found: np.ndarray, seed: int
) -> tuple[float, np.ndarray]:
    """An eigenvalue and vector from inverse iteration in a bracket, then Rayleigh quotients."""
    matrix, nudge = slices.matrix, slices.near / 8 or np.finfo(float).tiny
    vector = _without(np.random.default_rng(seed).standard_normal(len(matrix)), found)
    for _ in range(2):
        vector = _without(_solved(matrix, (low + high) / 2, vector, nudge), found)
    value, left = float(vector @ matrix @ vector), np.inf
    for _ in range(20):
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if residual >= left / 2:
            break
        left = residual
        vector = _without(_solved(matrix, value, vector, nudge), found)
        value = float(vector @ matrix @ vector)
    return value, vector


def leading_components(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance matrix and their unit vectors, as rows.

    Eigenvalues that rounding cannot tell from 0 are left out.  Of equal eigenvalues, the
    vectors are some orthonormal ones.  The entry of largest amount of a vector is positive.
    """
    n = len(matrix)
    slices = _Slices(matrix)
    if not slices.norm:
        return np.empty(0), np.empty((0, n))
    wanted = min(components, slices.above(16 * slices.near))
    values, vectors = [], np.empty((0, n))
    for k in range(1, wanted + 1):
        low, high = slices.isolated(k)
        while True:
            value, vector = _rayleigh(slices, low, high, vectors, seed=k)
            inside = low - slices.near <= value <= high + slices.near
            if inside and slices.certified(k, value):
                break
            if high - low <= slices.near:
                raise ArithmeticError(f"component {k} is not certified")
            low, high = slices.halved(k)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    largest = np.abs(vectors).argmax(axis=1)
    signs = np.sign(vectors[np.arange(len(vectors)), largest])
    return np.array(values), vectors * signs[:, None]


# -- exact sums over the rows ------------------------------------------------


def _numbers(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each."""
    flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(-1, dimension)


_PARTS = 4
_SUMS = "i int, j int, " + ", ".join(f"part{p} long" for p in range(_PARTS))


def _parts(values: Sequence[int]) -> list[list[int]]:
    """Whole numbers of up to 128 bits as four columns whose sums stand for their sum."""
    low = (1 << 32) - 1
    return [[(v >> (32 * p)) & low for v in values] for p in range(_PARTS - 1)] + [
        [v >> (32 * (_PARTS - 1)) for v in values]
    ]


def _whole(row: Sequence[int]) -> int:
    return sum(part << (32 * p) for p, part in enumerate(row))


def _sum_table(i: Sequence[int], j: Sequence[int], values: Sequence[int]) -> pa.RecordBatch:
    columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
    columns += [pa.array(part, pa.int64()) for part in _parts(values)]
    names = ["i", "j", *[f"part{p}" for p in range(_PARTS)]]
    return pa.RecordBatch.from_arrays(columns, names)


def _summing(dimension: int):
    """Number of rows, at (-1, -1), and sum of each entry, at (i, -1), of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimension
        for batch in batches:
            x = _numbers(batch, dimension)
            n += len(x)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(l) for t, h, l in zip(total, high, low)]
        yield _sum_table([-1, *range(dimension)], [-1] * (dimension + 1), [n, *total])

    return run


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Numbers as sums of ``limb * 2 ** (20 * place)``, limbs of at most 20 bits and a sign."""
    out = []
    while True:
        low = y & ((1 << _LIMB) - 1) if np.abs(y).max(initial=0) >> _LIMB else y
        out.append(low.astype(np.float64))
        y = (y - low) >> _LIMB
        if not y.any():
            return out


def _products(dimension: int, centre: np.ndarray):
    """Sums of products of the entries less ``centre``, at (i, j), and of the entries, at (i, -1).

    Limbs of 20 bits make the products of 4096 rows exact in doubles, hence the sums.
    """
    i, j = np.triu_indices(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = [0] * len(i)
        total = [0] * dimension
        for batch in batches:
            every = _numbers(batch, dimension) - centre
            for at in range(0, len(every), _ROWS):
                y = every[at : at + _ROWS]
                total = [t + int(v) for t, v in zip(total, y.sum(axis=0))]
                limbs = _limbs(y)
                for a, left in enumerate(limbs):
                    for b, right in enumerate(limbs):
                        part = (left.T @ right)[i, j].astype(np.int64).tolist()
                        shift = _LIMB * (a + b)
                        products = [p + (v << shift) for p, v in zip(products, part)]
        rows = [*i.tolist(), *range(dimension)]
        yield _sum_table(rows, [*j.tolist(), *[-1] * dimension], [*products, *total])

    return run


def _summed(rows: DataFrame, run) -> dict[tuple[int, int], int]:
    """The sums of all partitions; as many rows as the table of one partition has."""
    parts = [f"part{p}" for p in range(_PARTS)]
    totals = rows.mapInArrow(run, _SUMS).groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in parts])
    return {(r[0], r[1]): _whole(r[2:]) for r in totals.collect()}


# -- the job -----------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, sums of entries, eigenvalues, components as rows, total variance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def usable_rows(embeddings: DataFrame, carry: Sequence[str], vector: str) -> tuple[DataFrame, int]:
    """(row, vector) of the rows with a usable vector, and its dimension.

    Left out are vectors that are NULL or hold NULL, NaN, infinite entries or entries of
    2^52 and more, and vectors that have not the commonest length (of equally common ones,
    the greatest).
    """
    packed = embeddings.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{vector}`").alias("vector")
    )

    def fits(entry: Column) -> Column:
        # NaN is the largest number of Spark, so the comparison is false for it.
        return F.coalesce(F.abs(entry.cast("double")) < LARGEST, F.lit(False))

    whole = packed.filter(F.col("vector").isNotNull() & F.forall("vector", fits))
    common = (
        whole.groupBy(F.size("vector").alias("size"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.desc("size"))
        .first()
    )
    dimension = common["size"] if common else 0
    return whole.filter(F.size("vector") == dimension), dimension


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the column ``vector``, from all rows, in two passes."""
    ship(rows.sparkSession)
    totals = _summed(rows, _summing(dimension)) if dimension else {}
    n = totals.get((-1, -1), 0)
    sums = [totals[i, -1] for i in range(dimension)] if n else []
    if not n:
        return Whitening(0, np.empty(0, object), np.empty(0), np.empty((0, 0)), 0.0)
    # Centred at the nearest whole number; what is left over is taken off exactly.
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    products = _summed(rows, _products(dimension, centre))
    over = [products[i, -1] for i in range(dimension)]
    covariance = np.empty((dimension, dimension))
    for i in range(dimension):
        for j in range(i, dimension):
            exact = n * products[i, j] - over[i] * over[j]
            covariance[i, j] = covariance[j, i] = exact / (n * n)
    values, vectors = leading_components(covariance, components)
    return Whitening(n, np.array(sums, object), values, vectors, float(np.trace(covariance)))


def _residuals(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``x - S / n`` as doubles, ``n * x - S`` modulo 2^64, and about its squares' sum."""
    base, rest = zip(*[divmod(int(s), model.n) for s in model.sums])
    whole = x - np.array(base, np.int64)
    rest = np.array(rest, np.int64)
    exact = whole * np.int64(model.n) - rest
    centred = whole - rest / model.n
    return centred, exact, (centred**2).sum(axis=1) * float(model.n) ** 2


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred @ model.vectors.T) / np.sqrt(model.values)


def _deviations(x: np.ndarray, exact: np.ndarray, about: np.ndarray, model: Whitening) -> pa.Array:
    """Sums of squares of ``n * x - S``; NULL where a long cannot hold one.

    Arithmetic modulo 2^64 is exact for every sum that fits; the few sums near the limit are
    worked out in full.
    """
    sums = (exact * exact).sum(axis=1)
    limit = float(2**63)
    known = (about < 0.999 * limit).tolist()
    out = sums.tolist()
    for r in np.flatnonzero(about >= 0.999 * limit):
        if about[r] < 1.001 * limit:
            full = sum((model.n * int(v) - int(s)) ** 2 for v, s in zip(x[r], model.sums))
            out[r], known[r] = full, full < 2**63
    return pa.array([v if k else None for v, k in zip(out, known)], pa.int64())


def _projecting(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _numbers(batch, model.dimension)
            centred, exact, about = _residuals(x, model)
            white = _whitened(centred, model)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
            columns = [batch["row"], _deviations(x, exact, about, model), lists]
            yield pa.RecordBatch.from_arrays(columns, ["row", "deviation", "whitened"])

    return run


def _checking(model: Whitening):
    """Sums of the whitened values, at (i, -1), and of their products, at (i, j)."""
    k = len(model.values)
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            centred, _, _ = _residuals(_numbers(batch, model.dimension), model)
            white = _whitened(centred, model)
            total += white.sum(axis=0)
            products += white.T @ white
        rows = pa.array(np.concatenate([i, np.arange(k)]), pa.int32())
        columns = pa.array(np.concatenate([j, np.full(k, -1)]), pa.int32())
        values = pa.array(np.concatenate([products[i, j], total]))
        yield pa.RecordBatch.from_arrays([rows, columns, values], ["i", "j", "value"])

    return run


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry, in amount, of the covariance of the whitened values minus the identity.

    Measured over the rows themselves.  Sums of the partitions are added as decimals, so
    their order does not show.
    """
    measured = rows.mapInArrow(_checking(model), "i int, j int, value double")
    decimals = measured.withColumn("value", F.col("value").cast("decimal(38,17)"))
    added = decimals.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    sums = {(r.i, r.j): float(r.value) for r in added}
    n, worst = model.n, 0.0
    for (i, j), value in sums.items():
        if j >= 0:
            covariance = value / n - sums[i, -1] / n * (sums[j, -1] / n)
            worst = max(worst, abs(covariance - (i == j)))
    return worst


def whiten(
    embeddings: DataFrame,
    carry: Sequence[str] = ("vec_id",),
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> tuple[DataFrame, Whitening, float]:
    """Rows (``carry``..., deviation, whitened), the fitted whitening and its identity error.

    ``whitened`` holds the components, the strongest first, each with variance 1 over all
    rows; ``deviation`` is the exact sum over the dimensions of ``(n * x - S) ** 2``, NULL
    when it does not fit a long.  The sign of a component is the same for all rows.

    * Rows without a usable vector (see :func:`usable_rows`) are left out.
    * Rows with one id, or with one vector, are rows of their own and all count.
    * Components without variance are left out: one row, equal rows or an empty table have
      none, so ``whitened`` is empty.
    * Columns not in ``carry`` are not read, whatever their names.
    """
    rows, dimension = usable_rows(embeddings, carry, vector)
    model = fit(rows, dimension, components)
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, deviation long, whitened array<double>"
    if not len(model.values):
        none = F.lit(None).cast("long"), F.array().cast("array<double>")
        plain = rows.select("row", none[0].alias("deviation"), none[1].alias("whitened"))
        return plain.select("row.*", "deviation", "whitened"), model, 0.0
    error = identity_error(rows, model)
    done = rows.mapInArrow(_projecting(model), schema)
    return done.select("row.*", "deviation", "whitened"), model, error


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """A row per vector and component; none for rows that :func:`whiten` leaves out."""
    rows, model, error = whiten(embeddings)
    explained = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    components = rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return components.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
