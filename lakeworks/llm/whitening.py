"""Whitening of embeddings by exact linear algebra.

Vectors become whole numbers, ``x = floor(SCALE * c) + OFFSET``. Their scatter matrix
``M = n * sum(x x') - S S'`` is a matrix of integers (n^2 times the covariance), summed exactly: products
of limbs in doubles inside a task, decimals across tasks. Only M (dimension squared) reaches the driver.

M's characteristic polynomial is found modulo many primes, each in a Spark task, by reduction to Hessenberg
form, and put together by Chinese remaindering; as M has no negative eigenvalue, trace and dimension bound the
coefficients, and so the number of primes. All roots are real, hence the number of roots above a point, with
multiplicity, is exactly the number of sign changes of the polynomial shifted there (Descartes); bisection
on that count isolates each of the largest roots to ``BITS`` bits beyond the size of the trace. A component is
the null space of M - e by inverse iteration in fixed-point arithmetic, made orthogonal to the components
before it, which also tells the vectors of a repeated eigenvalue apart.

Defined cases: rows whose vector is null, empty, holds null or non-finite entries are dropped; so are rows of
another length than most have (of equally frequent lengths the longest counts). Entries beyond ``LIMIT``
in size are taken as that. Repeated rows and ids count as often as they stand. Components with an eigenvalue of
zero have no whitened value and no rows, so equal vectors, a single one and empty tables give no rows. Of equal eigenvalues
any orthonormal vectors are components; they are the same for all rows. A ``deviation`` beyond 64 bits is
null. The work of the driver grows with the dimension only. Columns not named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
LIMIT = float(1 << 30)
COMPONENTS = 8
# Bits of a root beyond those of the trace, and of fixed-point numbers.
BITS, FIXED = 128, 448
# Products of limbs of so many bits, and sums of so many of them, are exact in doubles.
LIMB, ROWS = 15, 1 << 16
PRIME_TOP = 1 << 31


@dataclass(frozen=True)
class Whitening:
    """Count, sums of ``x - OFFSET``, components (a row each), their eigenvalues and shares of the total variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def usable(vector: str) -> Column:
    """Whether a vector is not null, not empty and has only finite entries."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd


def _named(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    held = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return held.where(usable("vector"))


def dimension(vectors: DataFrame) -> int:
    """The length most usable vectors have; 0 if there are none."""
    size = vectors.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("m"))
    top = size.orderBy(F.desc("m"), F.desc("size")).first()
    return top["size"] if top else 0


def whole(column: pa.Array, d: int) -> np.ndarray:
    """``x - OFFSET`` of some vectors, a row each."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * np.clip(c, -LIMIT, LIMIT)).astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits of ``LIMB`` bits as doubles, the lowest first; as many as the largest entry needs."""
    out = []
    while True:
        digit = ((y + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        out.append(digit.astype(np.float64))
        y = (y - digit) >> LIMB
        if not y.any():
            return out


def _products(y: np.ndarray) -> np.ndarray:
    """Sum of y y' over the rows, in Python integers."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for at in range(0, len(y), ROWS):
        limbs = _limbs(y[at:at + ROWS])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total = total + ((a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j)))
    return total


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, sums and the exact matrix n * sum(y y') - S S' of vectors of ``d`` entries. A task sends a row per entry."""
    upper = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                y = whole(batch.column(0), d)
                n, sums, total = n + len(y), sums + y.sum(axis=0).astype(object), total + _products(y)
        if n:
            values = [n, *sums, *(total[i, j] for i, j in upper)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array([str(v) for v in values])], ["entry", "value"])

    parts = vectors.select("vector").mapInArrow(run, "entry int, value string")
    found = parts.groupBy("entry").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    got = {r["entry"]: int(r["value"]) for r in found.collect()}
    n, sums = got[0], [got[1 + i] for i in range(d)]
    m = np.zeros((d, d), object)
    for k, (i, j) in enumerate(upper):
        m[i, j] = m[j, i] = n * got[1 + d + k] - sums[i] * sums[j]
    return n, sums, m


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2^32."""
    if n % 2 == 0:
        return n == 2
    s = ((n - 1) & -(n - 1)).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, (n - 1) >> s, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(m: np.ndarray) -> list[int]:
    """Primes whose product passes twice the largest coefficient: sums of products of k eigenvalues, at most C(d, k) (trace / d)^k."""
    d, trace = len(m), int(sum(m[i, i] for i in range(len(m))))
    bound = 2 * max(math.comb(d, k) * (trace ** k // d ** k + 1) for k in range(d + 1))
    out, product, p = [], 1, PRIME_TOP - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_modulo(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t - m) modulo p, the lowest first. Entries stay below 2^31, so products fit 64 bits."""
    d = len(m)
    h = np.array([[int(v) % p for v in row] for row in m], np.int64).reshape(d, d)
    for k in range(1, d - 1):
        rows = np.flatnonzero(h[k:, k - 1])
        if not len(rows):
            continue
        r = k + rows[0]
        if r != k:
            h[[k, r]] = h[[r, k]]
            h[:, [k, r]] = h[:, [r, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(axis=1)) % p
    grown = np.zeros((d + 1, d + 1), np.int64)
    grown[0, 0] = 1
    for k in range(1, d + 1):
        grown[k, 1:] = grown[k - 1, :-1]
        grown[k] = (grown[k] - h[k - 1, k - 1] * grown[k - 1] % p) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            grown[k] = (grown[k] - int(h[i - 1, k - 1]) * below % p * grown[i - 1] % p) % p
    return grown[d]


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients of det(t - m), the lowest first, for a symmetric integer matrix without negative eigenvalues."""
    d, moduli = len(m), primes(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(m, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["prime", "found"])

    tasks = min(len(moduli), max(1, spark.sparkContext.defaultParallelism))
    given = spark.range(len(moduli), numPartitions=tasks).select(F.element_at(F.lit(moduli), (F.col("id") + 1).cast("int")).cast("long").alias("prime"))
    residues = given.mapInArrow(run, "prime long, found array<long>").collect()
    out, product = [0] * (d + 1), 1
    for prime, found in sorted(residues):
        step = pow(product, -1, prime)
        for i, r in enumerate(found):
            out[i] += product * ((r - out[i]) * step % prime)
        product *= prime
    return [c - product if 2 * c > product else c for c in out]


def _above(polynomial: list[int], point: int, bits: int) -> int:
    """Roots of a polynomial, all of them real, above point / 2^bits: sign changes of the shifted coefficients."""
    d = len(polynomial) - 1
    c = [a << (bits * (d - i)) for i, a in enumerate(polynomial)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], trace: int, count: int) -> tuple[list[int], int]:
    """The ``count`` largest roots above zero, falling, as whole numbers over 2^bits, and bits.

    A root is isolated to the right end of an interval (point, point + 1] of these numbers; the count of roots
    above a point is exact, so repeated and close roots come out as often as they are there.
    """
    # The least root above zero that is asked for may be far below the trace.
    bits, d = BITS, len(polynomial) - 1
    known = {0: _above(polynomial, 0, bits)}

    def above(point: int) -> int:
        if point not in known:
            known[point] = _above(polynomial, point, bits)
        return known[point]

    top, out = (trace + 1) << bits, []
    known[top] = 0
    for k in range(1, min(count, known[0], d) + 1):
        low = max(p for p, n in known.items() if n >= k)
        high = min(p for p, n in known.items() if n < k)
        # Bits of a root count from its own size: roots near the trace need no finer an interval.
        while high - low > max(1, high >> (BITS + 8)):
            middle = (low + high) >> 1
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        out.append(high)
    return out, bits


def _null_vector(m: np.ndarray, root: int, bits: int, before: list[np.ndarray], seed: int) -> np.ndarray:
    """Unit vector (times 2^FIXED) that m - root / 2^bits sends next to zero, orthogonal to those before."""
    d, trace = len(m), int(sum(m[i, i] for i in range(len(m))))
    one = 1 << FIXED
    # Elements of a matrix without negative eigenvalues are at most its trace.
    a = (m << FIXED) // trace
    for i in range(d):
        a[i, i] -= (root << FIXED) // (trace << bits)
    order = np.arange(d)
    for k in range(d):
        r = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
            order[[k, r]] = order[[r, k]]
        if not a[k, k]:
            a[k, k] = 1
        for i in range(k + 1, d):
            a[i, k] = (a[i, k] << FIXED) // a[k, k]
        if k + 1 < d:
            a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - ((a[k + 1:, k:k + 1] * a[k:k + 1, k + 1:]) >> FIXED)
    draw = np.random.default_rng(seed)
    v = np.array([int(x) << (FIXED - 20) for x in draw.integers(-(1 << 20), 1 << 20, d)], object)

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for w in before:
                v = v - ((w * int((v * w).sum() >> FIXED)) >> FIXED)
        size = math.isqrt(int((v * v).sum()))
        return (v << FIXED) // max(size, 1)

    v = unit(v)
    for _ in range(3):
        x = v[order].copy()
        for k in range(1, d):
            x[k] -= int((a[k, :k] * x[:k]).sum()) >> FIXED
        for k in range(d - 1, -1, -1):
            x[k] = ((x[k] - (int((a[k, k + 1:] * x[k + 1:]).sum()) >> FIXED)) << FIXED) // a[k, k]
        v = unit(x)
    return v


def fit(vectors: DataFrame, d: int, count: int = COMPONENTS) -> Whitening:
    """Components of usable vectors of ``d`` entries."""
    n, sums, m = scatter(vectors, d)
    trace = int(sum(m[i, i] for i in range(d)))
    if not trace:
        return Whitening(n, tuple(sums), np.zeros((0, d)), np.zeros(0), np.zeros(0))
    roots, bits = largest_roots(characteristic_polynomial(vectors.sparkSession, m), trace, count)
    found: list[np.ndarray] = []
    for k, root in enumerate(roots):
        found.append(_null_vector(m, root, bits, found, k))
    components = np.array([[_ratio(int(x), 1 << FIXED) for x in v] for v in found]).reshape(len(found), d)
    eigenvalues = np.array([_ratio(r, n * n << bits) for r in roots])
    return Whitening(n, tuple(sums), components, eigenvalues, np.array([_ratio(r, trace << bits) for r in roots]))


def _ratio(a: int, b: int) -> float:
    return a / b  # rounded once, whatever the size


def _centred(column: pa.Array, w: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * y - S of some vectors: exactly, and as doubles."""
    y = whole(column, len(w.sums))
    if w.n * (int(np.abs(y).max(initial=0)) + 1) + max(map(abs, w.sums)) < 1 << 62:
        exact = w.n * y - np.array(w.sums, np.int64)
    else:
        exact = w.n * y.astype(object) - np.array(w.sums, object)
    return exact, exact.astype(np.float64)


def _deviations(exact: np.ndarray) -> list[int | None]:
    """Sums of squares in integers; null beyond 64 bits."""
    if exact.dtype != object and len(exact) and float(np.abs(exact).max()) ** 2 * exact.shape[1] < 2.0 ** 62:
        return (exact * exact).sum(axis=1).tolist()
    return [t if t < 1 << 63 else None for t in (exact.astype(object) ** 2).sum(axis=1)] if len(exact) else []


def _projected(values: np.ndarray, w: Whitening) -> np.ndarray:
    return values / w.n @ w.components.T / np.sqrt(w.eigenvalues)


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest entry of whitened's covariance minus the identity, from the rows: a task sends its mean and centred products."""
    k = len(w.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = _projected(_centred(batch.column(0), w)[1], w)
                mean = z.mean(axis=0)
                values = np.concatenate([len(z) * mean, ((z - mean).T @ (z - mean) + len(z) * np.outer(mean, mean)).ravel()])
                yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["entry", "value"])

    parts = vectors.select("vector").mapInArrow(run, "entry int, value double")
    got = dict(parts.groupBy("entry").agg(F.sum("value")).collect())
    mean = np.array([got[i] for i in range(k)]) / w.n
    products = np.array([got[k + i] for i in range(k * k)]).reshape(k, k) / w.n
    # The mean is zero but for rounding, so taking its square off cancels nothing.
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for every usable vector and component."""
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    held = _named(rows, vec_id, vector)
    d = dimension(held)
    held = held.where(F.size("vector") == d)
    w = fit(held, d, count) if d else None
    if w is None or not len(w.eigenvalues):
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(held, w), len(w.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact, values = _centred(batch.column(1), w)
            each = np.repeat(np.arange(len(exact)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(exact)), pa.int32()),
                 pa.array(np.full(len(each), w.n), pa.int64()), pa.array(_deviations(exact), pa.int64()).take(pa.array(each)),
                 pa.array(_projected(values, w).ravel()), pa.array(np.tile(w.explained, len(exact))), pa.array(np.full(len(each), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return held.mapInArrow(run, schema)
