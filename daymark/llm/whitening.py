"""Whitening of vectors by an exact eigendecomposition of their integer scatter.

Every entry becomes an integer, so the scatter matrix ``n * sum(x x') - S S'``
(n squared times the covariance) is one of exact integers, summed by the tasks
that read the vectors.  Its characteristic polynomial is found exactly: each
task brings the matrix modulo a prime to Hessenberg form and reads the
polynomial off, and Chinese remaindering joins the residues.  As the matrix is
symmetric all roots are real, so the sign changes of the polynomial shifted to
``a`` count the roots above ``a`` exactly; the largest are isolated by these
counts and refined by bisection, on a grid of ``2 ** -PRECISION`` of the trace.
A component is the null space of the matrix less its root: inverse iteration
in integers of the same grid, again in a task.

What leaves the tasks is fixed by the dimension of the vectors, not by their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 1024
SHIFT = 100_000
#: Bits below the trace to which roots are found and null spaces solved.
PRECISION = 200
_LIMB = 20
_ROWS = 1 << 12
_WORD = 60
#: Larger scaled entries are not integers of a double, nor longs with the shift.
_LARGEST = float(1 << 52)


def usable(vector: Column) -> Column:
    """True for vectors with entries that are all numbers whose scaled value is below 2^52."""
    fits = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(_LARGEST / SCALE)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fits, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors' ``floor(1024 c)`` as int64, one row each; the shift does not change a covariance."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, dim)


def _gram(x: np.ndarray) -> np.ndarray:
    """x'x as Python integers: products of 20-bit limbs are exact in doubles over 4096 rows."""
    out = np.zeros((x.shape[1],) * 2, dtype=object)
    n_limbs = max(1, -(-int(np.abs(x).max(initial=0)).bit_length() // _LIMB))
    for lo in range(0, len(x), _ROWS):
        rest, limbs = x[lo : lo + _ROWS], []
        for _ in range(n_limbs):
            low = rest & ((1 << _LIMB) - 1) if len(limbs) < n_limbs - 1 else rest
            limbs.append(low.astype(np.float64))
            rest = (rest - low) >> _LIMB
        for a, left in enumerate(limbs):
            for b, right in enumerate(limbs):
                out = out + ((left.T @ right).astype(np.int64).astype(object) << (_LIMB * (a + b)))
    return out


def _moments(dim: int):
    """Row sums and products of a task as (i, j, high, low): the value is high * 2^60 + low; j = -1 has the sums, i = -1 the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            n += len(x)
            total = total + x.astype(object).sum(axis=0) if len(x) else total
            gram = gram + _gram(x)
        if n:
            i, j = np.triu_indices(dim)
            values = [n, *total.tolist(), *gram[i, j].tolist()]
            rows, cols = [-1, *range(dim), *i.tolist()], [-1, *[-1] * dim, *j.tolist()]
            parts = [[Decimal(v >> _WORD) for v in values], [Decimal(v & ((1 << _WORD) - 1)) for v in values]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), *[pa.array(p, pa.decimal128(38, 0)) for p in parts]], ["i", "j", "high", "low"]
            )

    return run


def scatter(vectors: DataFrame, vector_col: str, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums per dimension and ``n * sum(x x') - S S'``, all exact."""
    schema = "i int, j int, high decimal(38,0), low decimal(38,0)"
    parts = vectors.select(vector_col).mapInArrow(_moments(dim), schema)
    sums = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    n, total, gram = 0, [0] * dim, [[0] * dim for _ in range(dim)]
    # dim * (dim + 3) / 2 + 1 rows.
    for r in sums.collect():
        value = (int(r.high) << _WORD) + int(r.low)
        if r.i < 0:
            n = value
        elif r.j < 0:
            total[r.i] = value
        else:
            gram[r.i][r.j] = gram[r.j][r.i] = value
    return n, total, [[n * gram[i][j] - total[i] * total[j] for j in range(dim)] for i in range(dim)]


def primes_below(limit: int, count: int) -> list[int]:
    """The largest primes below ``limit`` (under 3.4e9), by a Miller-Rabin test that is exact there."""

    def prime(m: int) -> bool:
        odd, twos = m - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, m)
            if x not in (1, m - 1) and not any((x := x * x % m) == m - 1 for _ in range(twos - 1)):
                return False
        return True

    found, m = [], limit - 1 - limit % 2
    while len(found) < count:
        if prime(m):
            found.append(m)
        m -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, highest first, of det(x - matrix) modulo a prime below 2^31."""
    h = matrix % p
    d = len(h)
    for k in range(d - 2):
        pivots = np.flatnonzero(h[k + 1 :, k])
        if not len(pivots):
            continue
        at = k + 1 + int(pivots[0])
        if at != k + 1:
            h[[at, k + 1]] = h[[k + 1, at]]
            h[:, [at, k + 1]] = h[:, [k + 1, at]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    # Polynomials of the leading minors, lowest coefficient first.
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        factors, below = np.zeros(k, dtype=np.int64), 1
        for i in range(k - 1, -1, -1):
            factors[i] = int(h[i, k - 1]) * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (factors[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d, ::-1]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, highest first, of a matrix of integers that is symmetric and
    has no negative eigenvalue; one task step per prime."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # Maclaurin: the k-th elementary symmetric sum is at most C(d, k) (trace / d)^k.
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, -(-(2 * bound).bit_length() // 30))
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                small = np.array([[v % p for v in row] for row in shared.value], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(small, p)], pa.list_(pa.int64()))], ["p", "residues"])

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64)).mapInArrow(run, "p long, residues array<bigint>")
    value, product = [0] * (d + 1), 1
    for r in sorted(rows.collect(), key=lambda r: r.p):
        inverse = pow(product, -1, r.p)
        value = [v + product * ((c - v) * inverse % r.p) for v, c in zip(value, r.residues)]
        product *= r.p
    return [v - product if 2 * v > product else v for v in value]


@dataclass(frozen=True)
class Root:
    """``multiplicity`` roots (one, or some closer than the grid) at ``at`` units of the grid."""

    at: int
    multiplicity: int


def largest_roots(coefficients: list[int], k: int, bits: int) -> list[Root]:
    """The k largest positive roots, in units of ``2 ** -bits``, of a polynomial whose
    roots are all real and not negative, falling; the last may be more than k asks for."""
    scaled = [c << (bits * i) for i, c in enumerate(coefficients)]
    d = len(scaled) - 1
    positive = max((i for i, c in enumerate(scaled) if c), default=0)
    top = -scaled[1] if d else 0
    counts: dict[int, int] = {0: positive, top: 0}

    def above(a: int) -> int:
        """Roots above a: sign changes after a shift by a."""
        if a not in counts:
            b = list(scaled)
            for end in range(d, 0, -1):
                for j in range(1, end + 1):
                    b[j] += a * b[j - 1]
            signs = [c > 0 for c in b if c]
            counts[a] = sum(x != y for x, y in zip(signs, signs[1:]))
        return counts[a]

    def sign(a: int) -> int:
        v = 0
        for c in scaled:
            v = v * a + c
        return (v > 0) - (v < 0)

    found: list[Root] = []
    while (done := sum(r.multiplicity for r in found)) < min(k, positive):
        lo = max(a for a, n in counts.items() if n > done)
        hi = min(a for a, n in counts.items() if n <= done)
        while hi - lo > 1 and above(lo) - done > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if above(mid) > done else (lo, mid)
        many = above(lo) - done
        if many == 1:
            right = -1 if done % 2 else 1
            while hi - lo > 1:
                mid = (lo + hi) // 2
                s = sign(mid)
                lo, hi = (mid - 1, mid) if s == 0 else (lo, mid) if s == right else (mid, hi)
        found.append(Root(hi, many))
    return found


def null_space(matrix: list[list[int]], root: Root, bits: int) -> list[list[float]]:
    """Orthonormal vectors of the null space of the matrix less the root: inverse iteration
    in integers, units of ``2 ** -bits`` for the matrix, rounded to doubles at the end."""
    d = len(matrix)
    point = max(PRECISION, bits) + 64
    a = np.array([[v << bits for v in row] for row in matrix], dtype=object)
    a[np.diag_indices(d)] -= root.at
    lower, order = np.zeros((d, d), dtype=object), np.arange(d)
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        for m in (a, lower, order):
            m[[k, best]] = m[[best, k]]
        # An exact root leaves no pivot; a tiny one gives its null space.
        a[k, k] = a[k, k] or 1
        lower[k + 1 :, k] = (a[k + 1 :, k] << point) // a[k, k]
        a[k + 1 :, k + 1 :] -= (lower[k + 1 :, k][:, None] * a[k, k + 1 :]) >> point

    def solve(x: np.ndarray) -> np.ndarray:
        x = x[order]
        for k in range(d):
            x[k + 1 :] -= (lower[k + 1 :, k] * x[k]) >> point
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] - sum((a[k, k + 1 :] * x[k + 1 :]).tolist())) // a[k, k]
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        return (x << point) // math.isqrt(int((x * x).sum()))

    rng = np.random.default_rng(1)
    found: list[np.ndarray] = []
    for _ in range(root.multiplicity):
        x = np.array([int(v) << (point - 30) for v in rng.integers(1 << 28, 1 << 30, d)], dtype=object)
        for _ in range(3):
            x = unit(solve(x))
            for u in found:
                x = x - ((u * (int((u * x).sum()) >> point)) >> point)
            x = unit(x)
        found.append(x if x[max(range(d), key=lambda i: abs(x[i]))] > 0 else -x)
    return [[v / (1 << point) for v in x.tolist()] for x in found]


@dataclass(frozen=True)
class Whitening:
    """Rows and sums of the fit, components (one row each) with their eigenvalues and shares of the trace."""

    n: int
    dim: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def fit_whitening(vectors: DataFrame, *, vector_col: str = "embedding", components: int = 8) -> Whitening:
    """The components with the ``components`` largest eigenvalues, fitted on all usable rows.

    An entry c counts as ``floor(1024 c)``.  Rows whose vector is null, empty or holds an
    entry that is null, not finite or whose scaled value is 2^52 or more take no part, nor
    do vectors of another length than most have (of lengths equally common, the shortest
    counts).  Repeated rows count as often as they occur.  Directions
    without variance are no components, so there may be fewer (none for fewer than two
    different vectors or an empty table).  Equal eigenvalues give one orthonormal basis of
    their space.  A component's largest entry is positive.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    column = F.col(vector_col)
    rows = vectors.select(column.alias("v")).where(usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return Whitening(0, 0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    dim = sizes["dim"]
    n, sums, matrix = scatter(rows.where(F.size("v") == dim), "v", dim)
    trace = sum(matrix[i][i] for i in range(dim))
    bits = max(0, PRECISION - trace.bit_length())
    roots = largest_roots(characteristic_polynomial(spark, matrix), components, bits) if trace else []
    if not roots:
        return Whitening(n, dim, sums, np.zeros((0, dim)), np.zeros(0), np.zeros(0))
    shared = spark.sparkContext.broadcast((matrix, roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                matrix, roots = shared.value
                vectors = null_space(matrix, roots[i], bits)
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([vectors], pa.list_(pa.list_(pa.float64())))], ["root", "vectors"])

    numbers = spark.createDataFrame([(i,) for i in range(len(roots))], "root long").repartition(len(roots))
    solved = sorted(numbers.mapInArrow(run, "root long, vectors array<array<double>>").collect(), key=lambda r: r.root)
    units = [v for r in solved for v in r.vectors][:components]
    at = [r.at for r in roots for _ in range(r.multiplicity)][:components]
    return Whitening(
        n, dim, sums, np.array(units), np.array([v / ((n * n) << bits) for v in at]), np.array([v / (trace << bits) for v in at])
    )


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n x - S``, exact: int64 where it fits, else Python integers."""
    sums = np.array(model.sums, dtype=object)
    largest = model.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in model.sums), default=0)
    if largest < 1 << 62:
        return model.n * x - sums.astype(np.int64)
    return model.n * x.astype(object) - sums


def _squares(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    largest = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if y.dtype != object and largest * largest * y.shape[1] < 1 << 63:
        return (y * y).sum(axis=1).tolist()
    y = y.astype(object)
    return (y * y).sum(axis=1).tolist()


def _project(y: np.ndarray, model: Whitening) -> np.ndarray:
    return (y / model.n).astype(np.float64) @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def _fitted(vectors: DataFrame, vector_col: str, model: Whitening) -> DataFrame:
    return vectors.where(usable(F.col(vector_col)) & (F.size(vector_col) == model.dim))


def whiten(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component from 1, deviation, whitened) of every usable row and component.

    ``deviation`` is the exact sum over the dimensions of ``(n x - S)^2``, null where it has
    more than 38 digits; ``whitened`` the projection of ``x - S/n`` over the root of
    the eigenvalue.  Rows that the fit leaves out have none; null and repeated ids are
    rows like others; other columns are dropped.
    """
    ident = vectors.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, ident), T.StructField("component", T.IntegerType()),
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
    ])
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    limit = 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.components)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            y = _centred(_matrix(batch.column(1), model.dim), model)
            row = np.repeat(np.arange(batch.num_rows), k)
            deviation = pa.array([Decimal(v) if v < limit else None for v in _squares(y)], pa.decimal128(38, 0))
            which = np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(which), deviation.take(pa.array(row)), pa.array(_project(y, model).ravel())],
                [id_col, "component", "deviation", "whitened"],
            )

    return _fitted(vectors, vector_col, model).select(id_col, vector_col).mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Whitening, *, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity (0 without components)."""
    k = len(model.components)
    if not k:
        return 0.0
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    i, j = np.triu_indices(k)
    pairs = [*[(-1, b) for b in range(k)], *zip(i.tolist(), j.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = _project(_centred(_matrix(batch.column(0), model.dim), model), model)
                total += np.vstack([w.sum(axis=0), w.T @ w])
        values = [Decimal(float(total[a + 1, b])).quantize(Decimal("1e-18")) for a, b in pairs]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.int32()), pa.array([b for _, b in pairs], pa.int32()), pa.array(values, pa.decimal128(38, 18))], ["i", "j", "v"]
        )

    # Decimal sums do not depend on the order of the tasks.
    parts = _fitted(vectors, vector_col, model).select(vector_col).mapInArrow(run, "i int, j int, v decimal(38,18)")
    total = {(r.i, r.j): float(r.v) for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = [total[-1, b] / model.n for b in range(k)]
    return max(abs(total[a, b] / model.n - mean[a] * mean[b] - (a == b)) for a, b in pairs if a >= 0)


__all__ = [
    "Root", "Whitening", "characteristic_polynomial", "fit_whitening", "identity_error", "largest_roots", "null_space",
    "polynomial_modulo", "primes_below", "scatter", "usable", "whiten",
]
