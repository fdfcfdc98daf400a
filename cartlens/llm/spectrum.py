"""Whitening of embeddings by spectrum slicing.

The covariance comes from exact integer sums over all vectors, made in the tasks and added up by
Spark, so it does not depend on the order of rows; only it, a square of the dimension, reaches the
driver. There the leading eigenvalues are found by slicing: the signs of the pivots of LDL' of the
shifted covariance count the eigenvalues above the shift, bisection on the counts isolates each of the
leading ones, Rayleigh quotient iteration converges from inside its interval, and two more counts
certify its number. Eigenvalues too close to be told apart are taken as one block. Two more scans
project the vectors: one measures how white the result is, one returns it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, longs, picked
from cartlens.session import materialize

COMPONENTS = 8
SCALE = 1024.0
OFFSET = 100_000
# An entry of this size or more does not fit the exact sums.
LARGEST = float(1 << 40)
# Eigenvalues below this share of the largest cannot be whitened in double precision.
SMALLEST = 1e-10
# Eigenvalues closer than this share of the largest are one block.
CLOSE = 1e-6
# Rounding errors of a count of eigenvalues, as a share of the largest.
MARGIN = 1e-11
EXACT_FLOAT = float(1 << 53)
EXACT_LONG = float(1 << 62)


# ------------------------------------------------------------------- slicing


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of negative, zero and positive eigenvalues of a symmetric matrix, from LDL' with blocks of
    one or two rows and complete pivoting."""
    a = np.array(matrix, dtype=np.float64)
    negative = positive = 0
    while len(a):
        size = np.abs(a)
        r = int(np.argmax(np.diagonal(size)))
        diagonal = size[r, r]
        np.fill_diagonal(size, 0.0)
        p, q = divmod(int(np.argmax(size)), len(a))
        largest = size[p, q]
        if diagonal == 0.0 and largest == 0.0:
            break
        if diagonal >= 0.6404 * largest:  # (1 + sqrt 17) / 8 bounds the growth of the rest
            rows = [r]
            if a[r, r] > 0:
                positive += 1
            else:
                negative += 1
        else:
            rows = [p, q]  # the off-diagonal entry outweighs both diagonal ones: one value of each sign
            positive, negative = positive + 1, negative + 1
        rest = np.delete(np.arange(len(a)), rows)
        across = a[np.ix_(rest, rows)]
        a = a[np.ix_(rest, rest)] - across @ np.linalg.solve(a[np.ix_(rows, rows)], across.T)
        a = (a + a.T) / 2
    return negative, len(matrix) - negative - positive, positive


class Slices:
    """Counts of eigenvalues above shifts of one covariance."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.top = float(np.abs(matrix).sum(axis=1).max()) if len(matrix) else 0.0  # bounds every eigenvalue
        self.known: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            shifted = self.matrix - shift * np.eye(len(self.matrix))
            self.known[shift] = inertia(shifted)[2]
        return self.known[shift]

    def isolate(self, low: float, high: float) -> list[tuple[float, float, int, int]]:
        """Intervals (low, high, number of the first, how many) with one eigenvalue, or a block of close ones."""
        before, after = self.above(high), self.above(low)
        if before == after:
            return []
        if after - before == 1 or high - low <= CLOSE * self.top:
            return [(low, high, before + 1, after - before)]
        middle = (low + high) / 2
        return self.isolate(middle, high) + self.isolate(low, middle)

    def halve(self, low: float, high: float, before: int) -> tuple[float, float]:
        """The half of an interval that holds its first eigenvalue."""
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) > before else (low, middle)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    for k in range(4):  # an exact eigenvalue makes the matrix singular; then step aside by a rounding error
        try:
            return np.linalg.solve(matrix - (shift + k * tiny) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("the shifted covariance is singular")


def rayleigh(slices: Slices, low: float, high: float, number: int) -> tuple[float, np.ndarray]:
    """The one eigenvalue inside (low, high] and its vector."""
    a, tiny = slices.matrix, np.finfo(float).eps * slices.top
    while True:
        v = np.random.default_rng(number).standard_normal(len(a))
        v /= np.linalg.norm(v)
        for _ in range(3):  # inverse iteration turns towards the interval
            v = _solve(a, (low + high) / 2, v, tiny)
            v /= np.linalg.norm(v)
        best = (np.inf, 0.0, v)
        for _ in range(30):
            value = float(v @ a @ v)
            error = float(np.linalg.norm(a @ v - value * v))
            if error >= best[0] / 2 and best[0] <= 64 * tiny:
                break
            if error < best[0]:
                best = (error, value, v)
            v = _solve(a, value, v, tiny)
            v /= np.linalg.norm(v)
        error, value, v = best
        if low - MARGIN * slices.top <= value <= high + MARGIN * slices.top and error <= MARGIN * slices.top:
            return value, v
        if high - low <= tiny:
            raise ArithmeticError("Rayleigh quotient iteration left its interval")
        low, high = slices.halve(low, high, number - 1)


def block(slices: Slices, low: float, high: float, first: int, many: int) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues too close to be isolated: their common space by inverse iteration of a block."""
    a, tiny = slices.matrix, np.finfo(float).eps * slices.top
    q = np.linalg.qr(np.random.default_rng(first).standard_normal((len(a), many)))[0]
    errors = np.inf
    for _ in range(300):
        q = np.linalg.qr(_solve(a, (low + high) / 2, q, tiny))[0]
        values, turn = np.linalg.eigh(q.T @ a @ q)
        q = q @ turn
        before, errors = errors, float(np.abs(a @ q - q * values).max())
        if errors <= 4 * tiny or (errors <= MARGIN * slices.top and errors > before / 2):
            break
    if errors > MARGIN * slices.top:
        raise ArithmeticError("a block of close eigenvalues did not converge")
    return [(float(values[k]), q[:, k]) for k in range(many - 1, -1, -1)]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance, falling, and their unit vectors as columns; fewer if the
    others are zero within SMALLEST. Every number is certified by the counts on both sides."""
    slices = Slices(matrix)
    if slices.top == 0.0 or k < 1:
        return np.zeros(0), np.zeros((len(matrix), 0))
    found: list[tuple[float, np.ndarray]] = []
    # rows' sums bound the largest eigenvalue; one inner count gives its size for what counts as zero
    low, high = 0.0, slices.top * (1 + 1e-9)
    width, top = high, high
    while slices.above(top / 2) == 0:
        top /= 2
    wanted = min(k, slices.above(SMALLEST * top))
    # the shift that parts the wanted ones from the rest, roughly
    low = SMALLEST * top
    while width > CLOSE * slices.top and slices.above(low) > wanted:
        width = (high - low) / 2
        middle = low + width
        if slices.above(middle) >= wanted:
            low = middle
        else:
            high = middle
    for low, high, first, many in slices.isolate(low, slices.top * (1 + 1e-9)):
        pairs = [rayleigh(slices, low, high, first)] if many == 1 else block(slices, low, high, first, many)
        aside = MARGIN * slices.top
        if slices.above(pairs[0][0] + aside) != first - 1 or slices.above(pairs[-1][0] - aside) != first + many - 1:
            raise ArithmeticError(f"eigenvalue {first} is not certified")
        found += pairs
    found = found[:wanted]
    return np.array([value for value, _ in found]), np.stack([v for _, v in found], axis=1)


# ------------------------------------------------------------------- exact sums


def _exact_long(bound: float) -> bool:
    return bound < EXACT_LONG


def grids(column: pa.Array, scale: float, offset: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: the places of usable vectors, and floor(scale * entry) + offset as a matrix.

    A vector is usable if it and all its entries are known and finite.
    """
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    sound = np.isfinite(values)
    if flat.null_count:
        sound &= pc.is_valid(flat).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lengths, 0))
    faults = np.r_[0, np.cumsum(~sound)]
    usable = (lengths >= 0) & (faults[ends] == faults[ends - np.maximum(lengths, 0)])
    out = {}
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        grid = np.floor(scale * values[(ends[rows] - length)[:, None] + np.arange(length)[None, :]])
        if grid.size and np.abs(grid).max() >= LARGEST:
            raise ValueError(f"an entry is beyond {LARGEST / scale:g}")
        out[int(length)] = (rows, grid.astype(np.int64) + offset)
    return out


def _halves(values: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Integers of any size as a high part and the low 32 bits."""
    return longs((values >> 32).astype(np.int64)), longs((values & 0xFFFFFFFF).astype(np.int64))


def _joined() -> Column:
    wide = "decimal(38,0)"
    return F.sum(F.col("high").cast("decimal(20,0)")).cast(wide) * F.lit(1 << 32).cast("decimal(11,0)") + F.sum("low").cast("decimal(20,0)")


def _sums(vectors: DataFrame, scale: float, offset: int) -> DataFrame:
    """length, place, n, and the exact sum of the entries at that place, over vectors of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for length, (rows, x) in grids(batch.column(0), scale, offset).items():
                n, s = held.get(length, (0, np.zeros(length, object)))
                held[length] = n + len(rows), s + x.sum(axis=0).astype(object)
        for length, (n, s) in held.items():
            # a vector without entries has a row too, so that its length is counted
            s, places = (s, np.arange(length)) if length else (np.zeros(1, object), np.array([-1]))
            full = [longs(np.full(len(s), k)) for k in (length, n)]
            yield pa.RecordBatch.from_arrays([full[0], longs(places), full[1], *_halves(s)], ["length", "place", "n", "high", "low"])

    parts = vectors.select("embedding").mapInArrow(run, "length bigint, place bigint, n bigint, high bigint, low bigint")
    return parts.groupBy("length", "place").agg(F.sum("n").alias("n"), _joined().alias("s"))


class Center:
    """n vectors of one length with sums s; d = x - middle is small, and n * x - s = n * d - rest."""

    def __init__(self, n: int, s: Sequence[int]):
        self.n, self.s = n, list(s)
        self.middle = np.array([(2 * v + n) // (2 * n) for v in self.s], dtype=np.int64)
        self.rest = [v - n * int(m) for v, m in zip(self.s, self.middle)]

    def offset(self, x: np.ndarray) -> np.ndarray:
        return x - self.middle

    def centred(self, d: np.ndarray) -> np.ndarray:
        """x - s / n in double precision."""
        return d - np.array([r / self.n for r in self.rest])

    def deviations(self, d: np.ndarray) -> pa.Array:
        """The exact sums of (n * x - s) squared."""
        n, rest = self.n, np.array(self.rest, object)
        bound = float(np.abs(d).max(initial=0) + 1)
        if _exact_long((n * bound) ** 2 * max(1, d.shape[1])):
            return longs(((n * d - rest.astype(np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        wide = not _exact_long(bound * bound * d.shape[1]) or not _exact_long(bound * n * d.shape[1])
        d = d.astype(object) if wide else d
        squares, products = (d * d).sum(axis=1).astype(object), (d * (rest if wide else rest.astype(np.int64))).sum(axis=1).astype(object)
        out = n * n * squares - 2 * n * products + sum(r * r for r in self.rest)
        from decimal import Decimal

        return pa.array(list(map(Decimal, out)), pa.decimal128(38, 0))


def _usable(center: Center, scale: float, offset: int) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Places of the usable vectors of the center's length, and their offsets from its middle."""
    size = len(center.s)

    def find(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, x = grids(column, scale, offset).get(size, (np.zeros(0, np.int64), np.zeros((0, size), np.int64)))
        return rows, center.offset(x)

    return find


def _products(vectors: DataFrame, find: Callable, size: int) -> DataFrame:
    """i, j, and the exact sum of d_i * d_j, for i <= j."""
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(len(i), object), False
        for batch in batches:
            _, d = find(batch.column(0))
            if not len(d):
                continue
            bound, some = float(np.abs(d).max()) ** 2 * len(d), True
            if bound < EXACT_FLOAT:  # whole numbers below 2^53: floating products are exact
                f = d.astype(np.float64)
                m = (f.T @ f).astype(np.int64)
            else:
                m = d.T @ d if _exact_long(bound) else d.astype(object).T @ d.astype(object)
            total = total + m[i, j].astype(object)
        if some:
            yield pa.RecordBatch.from_arrays([longs(i), longs(j), *_halves(total)], ["i", "j", "high", "low"])

    parts = vectors.select("embedding").mapInArrow(run, "i bigint, j bigint, high bigint, low bigint")
    return parts.groupBy("i", "j").agg(_joined().alias("s"))


def _covariance(center: Center, products: list[tuple[int, int, int]]) -> np.ndarray:
    v, n, r = np.zeros((len(center.s),) * 2), center.n, center.rest
    for i, j, s in products:
        v[i, j] = v[j, i] = (n * s - r[i] * r[j]) / (n * n)  # one division of whole numbers
    return v


def _whiteness(vectors: DataFrame, find: Callable, center: Center, project: np.ndarray) -> float:
    """Largest absolute entry of the projected vectors' covariance minus the identity."""
    k = project.shape[1]
    names = [f"m{a}_{b}" for a in range(k) for b in range(a, k)] + [f"s{a}" for a in range(k)]
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            z = center.centred(find(batch.column(0))[1]) @ project
            total += np.r_[(z.T @ z)[upper], z.sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names)

    parts = vectors.select("embedding").mapInArrow(run, ", ".join(f"{c} double" for c in names))
    sums = np.array(parts.agg(*[F.sum(c).alias(c) for c in names]).first()) / center.n
    moments, means = sums[: len(upper[0])], sums[len(upper[0]) :]
    return float(np.abs(moments - means[upper[0]] * means[upper[1]] - (upper[0] == upper[1])).max())


# ------------------------------------------------------------------- operator


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
    scale: float = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1, by falling eigenvalue), n, deviation
    (decimal(38,0), exact), whitened, explained, identity_error.

    A vector is used if it and all its entries are known and finite; its entries become
    floor(scale * entry) + offset. Vectors of another length than most (of equally many, the longest) are in
    another space and left out. Components whose eigenvalue is zero, or below SMALLEST of the largest, have no whitened
    values and no rows; so a table of equal vectors, one vector or none gives no rows. Repeated rows and null
    ids are kept; other columns are left out. An entry of LARGEST / scale or more is an error.

    Four scans; nothing but sums is shuffled. The driver holds the covariance, a square of the dimension.
    """
    rows = picked(vectors, vec_id=vec_id, embedding=embedding)
    sums = materialize(_sums(rows, scale, offset), "vector-sums")
    schema = (
        f"vec_id {field_type(vectors, vec_id)}, component int, n bigint, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    most = sums.groupBy("length").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    nothing = rows.sparkSession.createDataFrame([], schema)
    if most is None or most["length"] == 0:
        return nothing
    chosen = sums.filter(F.col("length") == most["length"]).orderBy("place").collect()
    center = Center(most["n"], [int(r["s"]) for r in chosen])
    find, size = _usable(center, scale, offset), len(chosen)
    products = [(r["i"], r["j"], int(r["s"])) for r in _products(rows, find, size).collect()]
    covariance = _covariance(center, products)
    values, turn = leading(covariance, components)
    if not len(values):
        return nothing
    project = turn / np.sqrt(values)
    error = _whiteness(rows, find, center, project)
    shares, k = values / np.trace(covariance), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, d = find(batch.column(1))
            each = pa.array(np.repeat(np.arange(len(at)), k))
            many = len(at) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    longs(np.full(many, center.n)),
                    center.deviations(d).take(each),
                    pa.array((center.centred(d) @ project).ravel()),
                    pa.array(np.tile(shares, len(at))),
                    pa.array(np.full(many, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
