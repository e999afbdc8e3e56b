"""Embedding whitening from the exact characteristic polynomial.

Entries become integers (``floor(64 c) + 1000000``), so everything up to the eigenvalues is
exact:

1. Spark sums the integer vectors, then the scatter matrix of the vectors less a whole
   number near their mean: tasks multiply blocks of rows in pieces so small that doubles hold
   every product and sum exactly, and Spark adds the pieces.  From it follows the integer
   matrix ``M = n * sum(x x') - S S'``, which is ``n * n`` times the covariance.
2. Its characteristic polynomial: for each of as many 31-bit primes as bound the coefficients,
   a task brings ``M`` to Hessenberg form modulo the prime and reads the polynomial off by the
   usual recurrence; Chinese remaindering puts the integer coefficients together.
3. Its roots are all real, so Descartes' rule of signs counts them exactly, with multiplicity:
   the number right of ``t`` is the number of sign changes of ``p(x + t)``.  One task per
   component halves its interval with integers until it is ``BITS`` bits narrower than the
   matrix.  Roots of zero (dimensions that do not vary) are read off the lowest coefficients.
4. Eigenvectors are null vectors of ``M - r``: inverse iteration in fixed point of ``BITS``
   bits more than the matrix, one task per root; equal roots give as many vectors, made
   orthogonal.
5. Each row's centred vector is projected on the components and divided by the root of the
   eigenvalue; the covariance of these rows tells how far they are from white.

What the driver and the broadcasts hold is a matrix and a polynomial of the vectors'
dimension, whatever the number of rows.

Defined results: rows whose vector is NULL or holds NULL, NaN or infinite entries are
dropped, and so are vectors of another length than most (the longer where two lengths are
as frequent) and entries beyond ``LARGEST``, whose integers would not be exact; components without
variance have no whitened value and are left out, so constant vectors, a single row or an
empty table give no rows; repeated rows count as often as they stand there; equal eigenvalues
give some orthonormal basis of their space; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
# Entries are smaller than this, so that their integers fit 64 bits and sums of their squares 38 digits.
LARGEST = 2.0 ** 40
COMPONENTS = 32
# Bits of the roots and vectors beyond the matrix's own size.
BITS = 160
# Rows multiplied at a time, and bits of a piece: sums of products stay below 2 ** 53.
ROWS, PIECE = 1024, 20


# -- exact sums ----------------------------------------------------------------------------


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: the integer vectors of the rows that take part."""
    v = F.col("v")
    fine = v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(fine)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = size["d"] if size else 0
    return rows.where(F.size("v") == d).select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of a matrix."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), -1)


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and their sum by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                n, own = n + batch.num_rows, _matrix(batch.column(0)).sum(axis=0).astype(object)
                total = own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * (1 + len(total))), pa.array(range(-1, len(total)), pa.int32()), pa.array(["0", *map(str, total)])],
                                             ["n", "i", "s"])

    got = rows.select("x").mapInArrow(run, "n bigint, i int, s string")
    got = got.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (int(got[0]["n"]), [int(r["s"]) for r in got[1:]]) if got else (0, [])


def exact_gram(z: np.ndarray) -> np.ndarray:
    """``z' z`` in whole numbers (an array of Python integers).

    The entries are cut into pieces of ``PIECE`` bits, whose products and sums of ``ROWS``
    rows doubles hold exactly."""
    pieces, rest = [], z
    while rest.any():
        # Rounded to the nearest, so that a piece has PIECE bits with its sign.
        high = (rest + (1 << (PIECE - 1))) >> PIECE
        pieces.append((rest - (high << PIECE)).astype(np.float64))
        rest = high
    out = np.zeros((z.shape[1], z.shape[1]), object)
    for i, a in enumerate(pieces):
        for j in range(i, len(pieces)):
            part = (a.T @ pieces[j]).astype(np.int64).astype(object) * (1 << PIECE * (i + j))
            out += part if i == j else part + part.T
    return out


def scatter(rows: DataFrame, near: list[int]) -> dict[tuple[int, int], int]:
    """``sum((x - near) (x - near)')`` of all rows, upper half: tasks send their sums, Spark adds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = _matrix(batch.column(0)) - np.array(near, np.int64) if batch.num_rows else np.zeros((0, 0), np.int64)
            for k in range(0, len(z), ROWS):
                own = exact_gram(z[k:k + ROWS])
                total = own if total is None else total + own
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]], pa.string())], ["i", "j", "s"])

    got = rows.select("x").mapInArrow(run, "i int, j int, s string").groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in got.collect()}


def integer_matrix(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """``n``, ``S`` and ``M = n * sum(x x') - S S'``."""
    n, sums = totals(rows)
    if not n:
        return 0, [], []
    near = [s // n for s in sums]
    half, left = scatter(rows, near), [s - n * c for s, c in zip(sums, near)]
    d = len(sums)
    return n, sums, [[n * half[min(i, j), max(i, j)] - left[i] * left[j] for j in range(d)] for i in range(d)]


# -- characteristic polynomial ---------------------------------------------------------------


def primes_from(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    small = [p for p in range(2, math.isqrt(top) + 1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    out, high = [], top
    while len(out) < count:
        low = high - 40_000
        sieve = np.ones(high - low, bool)
        for p in small:
            sieve[-low % p::p] = False
        out += [low + int(k) for k in np.flatnonzero(sieve)[::-1]]
        high = low
    return out[:count]


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients (lowest first) of ``det(x - matrix)`` modulo a prime below 2 ** 31."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        j = k + int(below[0])
        if j != k:
            h[[k, j]] = h[[j, k]]
            h[:, [k, j]] = h[:, [j, k]]
        # Clear the column below the subdiagonal by a similarity.
        f = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - f[:, None] * h[k][None, :] % p) % p
        extra = np.zeros(d, np.int64)
        for i in np.flatnonzero(f):
            extra = (extra + f[i] * h[:, k + 1 + i]) % p
        h[:, k] = (h[:, k] + extra) % p
    polys = [np.array([1], np.int64)]
    for k in range(d):
        new = np.zeros(k + 2, np.int64)
        new[1:] = polys[k]
        new[:-1] = (new[:-1] - h[k, k] * polys[k]) % p
        run = 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            if not run:
                break
            new[:i + 1] = (new[:i + 1] - run * int(h[i, k]) % p * polys[i]) % p
        polys.append(new)
    return polys[d].tolist()


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient of the polynomial of a positive matrix is larger: its roots are at most
    its trace ``t`` together, so the elementary symmetric sums are below those of equal roots."""
    d, t = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    return max((math.comb(d, k) * t ** k // d ** k + 1 for k in range(d + 1)), default=1)


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The integers (symmetric around 0) with the given residues, by Garner's scheme."""
    values, modulus = list(residues[0][1]), residues[0][0]
    for p, own in residues[1:]:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((o - v) * inverse % p) for v, o in zip(values, own)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact integer coefficients, lowest first; the primes are dealt out to tasks."""
    bits = coefficient_bound(matrix).bit_length() + 2
    primes = primes_from(1 << 31, bits // 30 + 1)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [primes[k] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([polynomial_modulo(shared.value, p) for p in own], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    got = spark.range(len(primes), numPartitions=tasks).mapInArrow(run, "p bigint, c array<bigint>").collect()
    return remaindered(sorted((r["p"], list(r["c"])) for r in got))


# -- roots and vectors -----------------------------------------------------------------------


def changes_right_of(poly: list[int], t: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only lie right of ``t / 2 ** bits``."""
    # p(y / 2 ** bits) times 2 ** (bits d), then shifted by t.
    d = len(poly) - 1
    c = [v << bits * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += t * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def root_interval(poly: list[int], place: int, top: int, bits: int) -> tuple[int, int]:
    """``(low, high)`` over ``2 ** bits``: the ``place``-th largest root lies in (low, high].

    Halved over whole numbers first; the binary digits behind the point are added one at a
    time, so the integers are no longer than the precision reached."""
    low, high, at = 0, top, 0
    if changes_right_of(poly, 0, 0) < place:
        return 0, 0
    while high - low > 1 or at < bits:
        if high - low <= 1:
            step = min(8, bits - at)
            low, high, at = low << step, high << step, at + step
            continue
        mid = (low + high) // 2
        if changes_right_of(poly, mid, at) >= place:
            low = mid
        else:
            high = mid
    return low, high


def null_vectors(matrix: list[list[int]], root: Fraction, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the eigenvalue's space by inverse iteration in fixed
    point: Gaussian elimination with pivoting, then two solutions from each start."""
    d = len(matrix)
    unit = max(abs(v) for row in matrix for v in row).bit_length() + BITS
    one = 1 << unit
    shift = root.numerator * one // root.denominator
    a = np.array([[v * one - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)], object)
    order, factors = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        j = k + int(np.argmax(np.abs(a[k:, k])))
        if j != k:
            a[[k, j]], order[[k, j]], factors[[k, j], :k] = a[[j, k]], order[[j, k]], factors[[j, k], :k]
        if not a[k, k]:
            a[k, k] = 1  # the smallest number there is: the matrix is singular to the last bit
        if k + 1 < d:
            f = a[k + 1:, k] * one // a[k, k]
            factors[k + 1:, k] = f
            a[k + 1:, k:] -= (f[:, None] * a[k, k:][None, :]) >> unit

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order].copy()
        for k in range(d):
            y[k + 1:] -= (factors[k + 1:, k] * y[k]) >> unit
        x = np.zeros(d, object)
        for k in range(d - 1, -1, -1):
            x[k] = (y[k] - ((a[k, k + 1:] * x[k + 1:]).sum() >> unit if k + 1 < d else 0)) * one // a[k, k]
        return x

    def normal(x: np.ndarray) -> np.ndarray:
        size = math.isqrt(int((x * x).sum()))
        return x * one // max(size, 1)

    out: list[np.ndarray] = []
    rng = np.random.default_rng(20240229)
    while len(out) < count:
        v = normal(np.array([int(t) for t in rng.integers(-1 << 30, 1 << 30, d)], object))
        for _ in range(3):
            v = normal(solve(v))
            for u in out:
                v = v - (u * int((u * v).sum() >> unit) >> unit)
            v = normal(v)
        out.append(v)
    return [[float(Fraction(int(t), one)) for t in v] for v in out]


class Component(NamedTuple):
    eigenvalue: float       # of the covariance
    explained: float
    vector: list[float]


def components(spark, n: int, matrix: list[list[int]], most: int = COMPONENTS) -> list[Component]:
    """The components with the largest eigenvalues, those without variance left out."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return []
    poly = characteristic_polynomial(spark, matrix)
    zeros = next(k for k, c in enumerate(poly) if c)  # exact: the roots of zero
    wanted = min(most, d - zeros)
    shared = spark.sparkContext.broadcast((poly[zeros:], matrix, trace))

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly, _, trace = shared.value
        for batch in batches:
            got = [root_interval(poly, k, trace + 1, BITS) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([str(g[i]) for g in got]) for i in range(2))], ["place", "low", "high"])

    tasks = min(wanted, spark.sparkContext.defaultParallelism)
    places = spark.range(1, wanted + 1, numPartitions=tasks)
    found = sorted((r["place"], int(r["low"]), int(r["high"])) for r in places.mapInArrow(roots, "place bigint, low string, high string").collect())
    # Equal roots share a space: (first place, how many, twice the middle of the interval).  Roots
    # that are not equal but nearer than half of the bits count as equal.
    spaces: list[list[int]] = []
    for place, low, high in found:
        if spaces and spaces[-1][2] - (low + high) <= 1 << BITS // 2:
            spaces[-1][1] += 1
        else:
            spaces.append([place, 1, low + high])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, matrix, _ = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                first, count, twice = spaces[k]
                got = null_vectors(matrix, Fraction(twice, 1 << BITS + 1), count)
                yield pa.RecordBatch.from_arrays([pa.array(range(first, first + count), pa.int64()), pa.array(got, pa.list_(pa.float64()))], ["place", "v"])

    spread = spark.range(len(spaces), numPartitions=min(len(spaces), spark.sparkContext.defaultParallelism))
    own = {r["place"]: list(r["v"]) for r in spread.mapInArrow(vectors, "place bigint, v array<double>").collect()}
    roots_of = {place: Fraction(low + high, 1 << BITS + 1) for place, low, high in found}
    return [Component(float(roots_of[k] / (n * n)), float(roots_of[k] / trace), own[k]) for k in sorted(own)]


# -- whitening -------------------------------------------------------------------------------


def whitened_rows(rows: DataFrame, n: int, sums: list[int], parts: list[Component]) -> DataFrame:
    """``id, deviation, w``: the squared distance from the mean (times n squared, exact) and
    the whitened vector of every row."""
    axes = np.array([c.vector for c in parts]).T / np.sqrt([c.eigenvalue for c in parts])
    shared = rows.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, near = shared.value, np.array([s // n for s in sums], np.int64)
        left = [s % n for s in sums]
        for batch in batches:
            z = _matrix(batch.column(1)) - near if batch.num_rows else np.zeros((0, len(near)), np.int64)
            # n (x - mean), and the sum of its squares in Python's integers where 64 bits do not hold it.
            most = n * (int(np.abs(z).max(initial=0)) + 1)
            y = z * n - np.array(left, np.int64) if most < 1 << 62 else z.astype(object) * n - np.array(left, object)
            exact = y if most * most * len(near) < 1 << 63 else y.astype(object)
            far = (exact * exact).sum(axis=1).tolist()
            w = (y / n).astype(np.float64) @ axes
            ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * axes.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(v) for v in far], pa.string()), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                                             ["id", "far", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {kind}, far string, w array<double>")
    return got.select("id", F.col("far").cast("decimal(38,0)").alias("deviation"), "w")


def identity_error(white: DataFrame, n: int) -> float:
    """The largest entry of the whitened rows' covariance less the identity."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

    rows = white.select("w")
    mean = np.array([r["s"] for r in rows.mapInArrow(sums, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()]) / n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) - mean
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    total = rows.mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg((F.sum("s") / n).alias("c"))
    return total.agg(F.max(F.abs(F.col("c") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]


SCHEMA = "n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``id_col, n, deviation, whitened, explained, identity_error``: one row a vector, its
    whitened coordinates by component, the components' shares of the variance, and how far
    the whitened rows' covariance is from the identity."""
    spark = vectors.sparkSession
    rows = integers(vectors, id_col, vector_col)
    n, sums, matrix = integer_matrix(rows)
    parts = components(spark, n, matrix, most) if n else []
    if not parts:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
    white = whitened_rows(rows, n, sums, parts)
    error = identity_error(white, n)
    return white.select(F.col("id").alias(id_col), F.lit(n).cast("long").alias("n"), "deviation", F.col("w").alias("whitened"),
                        F.array(*(F.lit(c.explained) for c in parts)).alias("explained"), F.lit(error).alias("identity_error"))
