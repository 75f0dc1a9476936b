"""Whitening of embeddings by an exact characteristic polynomial.

Vectors become integers, so sums and products over any number of rows are exact: the scatter
matrix M = n**2 V (V: covariance of the distinct vectors, divisor n) is made of integers. Its
characteristic polynomial is computed modulo many primes, each by reduction to Hessenberg form
in a Spark task, and put together by Chinese remaindering. All roots are real, so Descartes'
rule counts those above a point exactly and bisection isolates them to any precision. Components
come from inverse iteration on the null space of M less a root, in many-digit arithmetic.

Rows never meet: tasks return sums of a size that depends on the dimension d only (d**2
integers), which the driver adds up. The driver also holds the d + 1 coefficients.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dunlin.llm.common import mix, stage

SCALE, SHIFT = 64, 1_000_000
#: Entries at or above this have no whole number of 53 bits after scaling.
LARGEST = float(1 << 47)
#: Relative precision (bits) of the roots; roots that are closer count as one of several.
BITS = 160
_DIGITS = 80
_HALF = 10**18  # sums travel as two longs, value = high * _HALF + low


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(id, x) of the rows (id, vector) that take part: x = floor(64 * entry) + 1000000. Rows
    that are NULL, or hold a NULL, non-finite or enormous entry (2**47 or more), are left out."""
    v = F.col("vector")
    usable = v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return vectors.where(usable).select(
        "id", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _safe(x: np.ndarray, factor: int) -> np.ndarray:
    """``x`` as Python integers if it may leave 64 bits when multiplied by ``factor``."""
    most = int(np.abs(x).max(initial=0))
    return x if most * factor < 1 << 62 else x.astype(object)


def exact_sums(x: np.ndarray) -> list[int]:
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [(int(a) << 26) + int(b) for a, b in zip(high.sum(0), low.sum(0))]


def exact_gram(y: np.ndarray) -> np.ndarray:
    """The integers yᵀy. Entries are cut into limbs of 20 bits, so that the products of at most
    8192 rows are exact in doubles."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a in range(0, len(y), 8192):
        part, limbs = y[a:a + 8192], []
        while True:
            last = int(np.abs(part).max(initial=0)) < 1 << 20
            limbs.append((part if last else part & ((1 << 20) - 1)).astype(np.float64))
            if last:
                break
            part = part >> 20
        for i, u in enumerate(limbs):
            for j, v in enumerate(limbs):
                total += (u.T @ v).astype(np.int64).astype(object) << 20 * (i + j)
    return total


def _summed(rows: DataFrame, d: int, made) -> dict[tuple[int, int], int]:
    """Exact sums over all rows of the integers ((i, j), value) that ``made`` returns for a
    block of vectors. Tasks add up their blocks, so the driver gets one row for each (i, j)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                block = made(_matrix(batch.column("x"), d))
                total = block if total is None else total + block
        if total is not None:
            at = list(np.ndindex(total.shape))
            values = [int(total[k]) for k in at]
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in at], pa.int32()), pa.array([k[-1] for k in at], pa.int32()),
                pa.array([v // _HALF for v in values], pa.int64()), pa.array([v % _HALF for v in values], pa.int64()),
            ], names=["i", "j", "high", "low"])

    parts = rows.select("x").mapInArrow(partial, "i int, j int, high bigint, low bigint")
    whole = parts.groupBy("i", "j").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
    return {(r.i, r.j): int(r.high) * _HALF + int(r.low) for r in whole.collect()}


def is_prime(n: int) -> bool:
    """Exact below 3,215,031,751 (Miller-Rabin with these bases)."""
    if n < 11:
        return n in (2, 3, 5, 7)
    r, s = n - 1, 0
    while r % 2 == 0:
        r, s = r // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, r, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_for(trace: int, d: int) -> list[int]:
    """Primes whose product is over twice any coefficient: the k-th is at most C(d, k) times
    the k-th power of the mean root."""
    bound = max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1)) * 2 + 1
    found, product, p = [], 1, (1 << 31) + 1
    while product <= bound:
        p -= 2
        if is_prime(p):
            found.append(p)
            product *= p
    return found


def hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Similar matrices of Hessenberg form; ``a`` (b, d, d) modulo the primes ``p`` (b)."""
    b, d, _ = a.shape
    q, each = p[:, None], np.arange(b)
    for k in range(d - 2):
        pivot = k + 1 + (a[:, k + 1:, k] != 0).argmax(1)
        rows = a[each, pivot].copy()
        a[each, pivot], a[:, k + 1] = a[:, k + 1].copy(), rows
        columns = a[each, :, pivot].copy()
        a[each, :, pivot], a[:, :, k + 1] = a[:, :, k + 1].copy(), columns
        inverse = np.array([pow(int(v), -1, int(m)) if v else 0 for v, m in zip(a[:, k + 1, k], p)], np.int64)
        m = a[:, k + 2:, k] * inverse[:, None] % q
        a[:, k + 2:] = (a[:, k + 2:] - m[:, :, None] * a[:, k + 1, None, :] % q[:, :, None]) % q[:, :, None]
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2:] * m[:, None, :] % q[:, :, None]).sum(2)) % q
    return a


def polynomials(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Characteristic polynomials (b, d + 1) of Hessenberg matrices, lowest coefficient first."""
    b, d, _ = h.shape
    q = p[:, None]
    out = np.zeros((d + 1, b, d + 1), np.int64)
    out[0, :, 0] = 1
    for k in range(1, d + 1):
        now = np.roll(out[k - 1], 1, axis=1)
        now = (now - h[:, k - 1, k - 1, None] * out[k - 1] % q) % q
        t = np.ones(b, np.int64)
        for i in range(k - 1, 0, -1):
            t = t * h[:, i, i - 1] % p
            now = (now - (h[:, i - 1, k - 1] * t % p)[:, None] * out[i - 1] % q) % q
        out[k] = now
    return out[d]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of the polynomial of a symmetric integer matrix without
    negative roots. The primes are dealt over tasks; each returns d + 1 residues a prime."""
    d = len(matrix)
    primes = primes_for(sum(matrix[i][i] for i in range(d)), d)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = [primes[k] for k in batch.column("id").to_pylist()]
            for a in range(0, len(mine), 16):
                p = np.array(mine[a:a + 16], np.int64)
                m = np.array([[[v % q for v in row] for row in matrix] for q in mine[a:a + 16]], np.int64)
                found = polynomials(hessenberg(m, p), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["p", "r"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(residues, "p bigint, r array<bigint>").collect()
    product = 1
    for r in rows:
        product *= r.p
    out = [0] * (d + 1)
    for r in rows:
        rest = product // r.p
        weight = rest * pow(rest, -1, r.p)
        out = [(c + v * weight) % product for c, v in zip(out, r.r)]
    return [c - product if 2 * c > product else c for c in out]


def roots_above(coefficients: list[int], a: int, s: int) -> int:
    """How many roots are greater than a / 2**s, each as often as it occurs. Exact when all
    roots are real: the sign changes of the polynomial moved by that much (Descartes)."""
    d = len(coefficients) - 1
    c = [v << s * (d - k) for k, v in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(coefficients: list[int], a: int, s: int) -> int:
    value, d = 0, len(coefficients) - 1
    for k in range(d, -1, -1):
        value = value * a + (coefficients[k] << s * (d - k))
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], wanted: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots of a polynomial with real roots only, falling, each with its
    multiplicity, until ``wanted`` are reached. Values are right to ``BITS`` bits."""
    first = next(k for k, c in enumerate(coefficients) if c)
    c = coefficients[first:]  # without the roots at zero
    if len(c) == 1:
        return []
    top = 1 << max(v.bit_length() for v in c[-2:])  # above the sum of the roots
    found: list[tuple[Fraction, int]] = []
    todo = [(0, top, 0, len(c) - 1, 0)]  # the highest interval last: (low, high] / 2**s, roots above both
    while todo and sum(m for _, m in found) < wanted:
        low, high, s, n_low, n_high = todo.pop()
        if n_low == n_high:
            continue
        if low and (high - low) << BITS <= low:
            found.append((Fraction(low + high, 2 << s), n_low - n_high))
            continue
        if n_low - n_high == 1:
            found.append((_refined(c, low, high, s), 1))
            continue
        if high - low == 1:
            low, high, s = low * 2, high * 2, s + 1
        middle = (low + high) // 2
        n = roots_above(c, middle, s)
        todo += [(low, middle, s, n_low, n), (middle, high, s, n, n_high)]
    return found


def _refined(c: list[int], low: int, high: int, s: int) -> Fraction:
    """The only root in (low, high] / 2**s, by the signs of the polynomial."""
    after = sign_at(c, high, s)
    while after and not (low and (high - low) << BITS <= low):
        if high - low == 1:
            low, high, s = low * 2, high * 2, s + 1
        middle = (low + high) // 2
        sign = sign_at(c, middle, s)
        if sign == 0:
            return Fraction(middle, 1 << s)
        low, high = (low, middle) if sign == after else (middle, high)
    return Fraction(low + high, 2 << s) if after else Fraction(high, 1 << s)


def null_space(matrix: list[list[int]], root: Fraction, count: int) -> list[list[Decimal]]:
    """Orthonormal vectors of a symmetric matrix for a root of the given multiplicity, by
    inverse iteration: one LU decomposition of the matrix less the root, two solutions each."""
    d = len(matrix)
    with localcontext(prec=_DIGITS):
        value = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= value
        least = max(abs(a).max(), Decimal(1)) * Decimal(10) ** (5 - _DIGITS)
        order = list(range(d))
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if best != k:
                a[[k, best]], order[k], order[best] = a[[best, k]], order[best], order[k]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        found: list[np.ndarray] = []
        seeds = mix(np.arange(1, d * count + 1, dtype=np.uint64)).reshape(count, d)
        for seed in seeds:
            v = np.array([Decimal(int(x % np.uint64(2001)) - 1000) / 1000 for x in seed], object)
            for _ in range(3):
                for u in found:
                    v = v - u * (u @ v)
                v = v[order] if d else v
                for k in range(1, d):
                    v[k] -= a[k, :k] @ v[:k]
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1:] @ v[k + 1:] if k + 1 < d else 0)) / a[k, k]
                for u in found:
                    v = v - u * (u @ v)
                v = v / (v @ v).sqrt()
            lead = max(v, key=abs)
            found.append(-v if lead < 0 else v)
        return [list(v) for v in found]


def components(spark, matrix: list[list[int]], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(d, k) vectors over the square roots of their roots, and the k roots over the trace. The
    roots are dealt over tasks; a task returns the vectors of its root."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    roots = largest_roots(characteristic_polynomial(spark, matrix), wanted) if trace else []
    if not roots:
        return np.zeros((len(matrix), 0)), np.zeros(0)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                root, count = roots[k]
                with localcontext(prec=_DIGITS):
                    norm = (Decimal(root.numerator) / Decimal(root.denominator)).sqrt()
                    out = [[float(x / norm) for x in v] for v in null_space(matrix, root, count)]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32()),
                                                  pa.array(out, pa.list_(pa.float64()))], names=["k", "nth", "v"])

    rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(solve, "k bigint, nth int, v array<double>").collect()
    rows = sorted(rows, key=lambda r: (r.k, r.nth))[:wanted]
    return np.array([r.v for r in rows]).T, np.array([float(roots[r.k][0] / trace) for r in rows])


def whiten(vectors: DataFrame, wanted: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of the rows
    (id, vector) that take part (see ``whole_numbers``), for each component up to ``wanted``.

    The fit is over the distinct vectors: ``n`` of them. ``deviation`` is the sum over
    dimensions of (n * x - sum)**2, NULL beyond 64 bits. Components without variance are left
    out, so a table of one distinct vector gives no rows, as does an empty one. Rows whose
    length is not the commonest (of equally common ones the largest) take no part. NULL and
    repeated ids are rows like others; equal vectors get equal values.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"id {dict(rows.dtypes)['id']}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if lengths is None or not lengths.d:
        return spark.createDataFrame([], schema)
    d = lengths.d
    rows = rows.where(F.size("x") == d)
    fit = stage(rows.select("x").distinct(), "fit")
    n = fit.count()
    sums = [v for _, v in sorted(_summed(fit, d, lambda x: np.array(exact_sums(x), object)).items())]
    middle = np.array([v // n for v in sums], np.int64)
    rest = [v % n for v in sums]
    gram = _summed(fit, d, lambda x: exact_gram(x - middle))
    matrix = [[n * gram[i, j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    weights, explained = components(spark, matrix, wanted)
    k = weights.shape[1]
    if not k:
        return spark.createDataFrame([], schema)
    left = np.array(rest, np.int64)

    def centred(x):  # n * x - sum, exactly
        y = _safe(x - middle, n + 1)
        return y * n - left

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = centred(_matrix(batch.column("x"), d)).astype(np.float64) @ weights
            first, second = first + z.sum(0), second + z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([first.tolist(), second.tolist()])])], names=["m"])

    parts = fit.mapInArrow(moments, "m string").select(F.from_json("m", "array<string>").alias("m")).select(
        F.posexplode(F.concat(F.from_json(F.col("m")[0], "array<double>"),
                              F.flatten(F.from_json(F.col("m")[1], "array<array<double>>")))).alias("at", "v"))
    total = np.array([r.v for r in parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]) / n
    mean, square = total[:k], total[k:].reshape(k, k)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches):
        for batch in batches:
            c = centred(_matrix(batch.column("x"), d))
            if not len(c):
                continue
            whole = _safe(c, int(np.abs(c).max()) * d)
            deviation = [int(v) if v < 1 << 63 else None for v in (whole * whole).sum(1)]
            z = c.astype(np.float64) @ weights
            m = len(c)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(z.reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
