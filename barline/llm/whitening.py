"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become whole numbers ``x``, so the scatter ``n * sum(x x') - S S'`` is a matrix of
whole numbers, summed without rounding: tasks add up their rows, and Spark adds the
tasks' sums, each cut into limbs that fit a long. Its characteristic polynomial is taken
modulo many primes, a prime to a row of a Spark table, by reduction to Hessenberg form;
Chinese remaindering puts the coefficients together. All roots are real, so the sign
changes of the shifted polynomial count the roots above a number exactly: roots are
isolated by bisection on that count and then refined by sign to ``BITS`` fractional
bits. A component is a null vector of the scatter minus its root, by inverse iteration
in fixed-point whole numbers, a root to a task. What reaches the driver is bounded by
the dimension: the scatter, one polynomial per prime and the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Fractional bits of a root, and of the numbers of the inverse iteration beyond them.
BITS = 96
GUARD = 160
# Entries from here on do not fit a long once scaled; they count as not finite.
LARGEST = 2.0**56
_LIMB_BITS, _LIMBS = 30, 6
_CHUNK = 4096
# Whole numbers below this are exact as doubles.
_EXACT = 2**53


class Spectrum(NamedTuple):
    """Roots of the scatter as ``numerator / 2**bits``, largest first, with their components."""

    rows: int
    sums: list[int]
    trace: int
    roots: list[tuple[int, int]]
    vectors: np.ndarray

    def variances(self) -> list[float]:
        """Eigenvalues of the covariance: those of the scatter over the squared row count."""
        return [_ratio(a, self.rows**2 << bits) for a, bits in self.roots]

    def explained(self) -> list[float]:
        return [_ratio(a, self.trace << bits) for a, bits in self.roots]


def _ratio(a: int, b: int) -> float:
    """``a / b`` for whole numbers of any size."""
    shift = max(a.bit_length(), b.bit_length()) - 1000
    return a / b if shift <= 0 else (a >> shift) / (b >> shift) if b >> shift else math.inf


# --- whole vectors and their scatter ------------------------------------------------


def whole_vectors(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``_id`` and ``_x`` (``floor(64 * c)`` per entry) of the vectors that take part."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    whole = F.transform(
        values, lambda c: F.when(F.abs(c) < LARGEST, F.floor(c * F.lit(float(SCALE))))
    )
    kept = table.where(F.col(vector).isNotNull() & sound & (F.size(vector) > 0)).select(
        F.col(vec_id).alias("_id"), whole.alias("_x")
    )
    # Vectors of one length: the most frequent one, the larger one on a tie.
    length = (
        kept.groupBy(F.size("_x").alias("d"))
        .count()
        .orderBy(F.desc("count"), F.desc("d"))
        .select("d")
        .first()
    )
    return kept.where(F.size("_x") == (length[0] if length else 0))


def _limbs(value: int) -> list[int]:
    """Signed limbs whose sums over any rows add up to the sum of the values."""
    sign, value = (-1, -value) if value < 0 else (1, value)
    return [sign * (value >> (_LIMB_BITS * k) & ((1 << _LIMB_BITS) - 1)) for k in range(_LIMBS)]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def _partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Row count, sums and upper triangle of the products of a task's rows, in limbs."""
    rows, sums, products = 0, None, None
    for batch in batches:
        for at in range(0, len(batch), _CHUNK):
            x = _matrix(batch["_x"].iloc[at : at + _CHUNK])
            if sums is None:
                d = x.shape[1]
                sums, products = np.zeros(d, object), np.zeros((d, d), object)
            top = max(int(x.max()), -int(x.min()))
            exact = top * top * len(x) < _EXACT
            y = x.astype(np.float64) if exact else x.astype(object)
            square, total = y.T @ y, y.sum(axis=0)
            if exact:
                square, total = square.astype(np.int64), total.astype(np.int64)
            products += square.astype(object)
            sums += total.astype(object)
            rows += len(x)
    if sums is None:
        return
    d = len(sums)
    # Line -1 holds the row count and the sums.
    found = [(-1, -1, rows), *((-1, j, int(sums[j])) for j in range(d))]
    found += [(i, j, int(products[i, j])) for i in range(d) for j in range(i, d)]
    yield pd.DataFrame(
        [(i, j, *_limbs(v)) for i, j, v in found],
        columns=["_i", "_j", *[f"_l{k}" for k in range(_LIMBS)]],
    )


def scatter(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Row count, sums and ``n * sum(x x') - S S'``, all exact."""
    limbs = [f"_l{k}" for k in range(_LIMBS)]
    schema = "_i int, _j int, " + ", ".join(f"{c} bigint" for c in limbs)
    lines = (
        vectors.select("_x")
        .mapInPandas(_partial_sums, schema)
        .groupBy("_i", "_j")
        .agg(*[F.sum(c).alias(c) for c in limbs])
        .collect()  # one row per pair of dimensions
    )
    values = {
        (r["_i"], r["_j"]): sum(r[c] << (_LIMB_BITS * k) for k, c in enumerate(limbs)) for r in lines
    }
    rows = values.get((-1, -1), 0)
    d = max((j for _, j in values), default=-1) + 1
    sums = [values[-1, j] for j in range(d)]
    return rows, sums, [
        [rows * values[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)
    ]


# --- characteristic polynomial --------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide below 3.2 * 10**9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, largest first, whose product exceeds ``bound``."""
    found, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: Sequence[Sequence[int]], p: int) -> list[int]:
    """Coefficients (constant first) of the characteristic polynomial modulo ``p`` < 2**31."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    n = len(a)
    for k in range(1, n - 1):
        filled = np.flatnonzero(a[k:, k - 1])
        if not len(filled):
            continue
        pivot = k + int(filled[0])
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        factor = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :, k - 1 :] = (a[k + 1 :, k - 1 :] - np.outer(factor, a[k, k - 1 :])) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # Row k holds the polynomial of the leading k x k part.
    poly = np.zeros((n + 1, n + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, n + 1):
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(a[i, k - 1]) * below % p
            below = below * int(a[i, i - 1]) % p if i else 0
        poly[k, 1:] = poly[k - 1, :-1]
        poly[k] = (poly[k] - (weights[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[n].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, constant first; one task row per prime.

    A scatter has no negative root, so no coefficient exceeds ``(1 + trace / d) ** d``.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    primes = primes_beyond(2 * (2 + trace // d) ** d)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [polynomial_mod(matrix, int(p)) for p in batch["p"]]
            yield pd.DataFrame({"p": batch["p"], "c": found})

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    lines = (
        spark.createDataFrame([(p,) for p in primes], "p bigint")
        .repartition(tasks)
        .mapInPandas(reduced, "p bigint, c array<bigint>")
        .collect()  # one row per prime
    )
    values, product = [0] * (d + 1), 1
    for line in lines:
        p, inverse = line["p"], pow(product, -1, line["p"])
        values = [
            v + product * ((c - v) * inverse % p) for v, c in zip(values, line["c"], strict=True)
        ]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


# --- roots ------------------------------------------------------------------------------


def roots_above(poly: Sequence[int], a: int) -> int:
    """Roots greater than ``a`` with multiplicity, for a polynomial with real roots only.

    Descartes' rule is exact there: the sign changes of ``poly(x + a)``.
    """
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def scaled(poly: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of ``poly`` times ``2**bits``."""
    d = len(poly) - 1
    return [c << (bits * (d - i)) for i, c in enumerate(poly)]


def _sign(poly: Sequence[int], x: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * x + c
    return (value > 0) - (value < 0)


def isolated(
    poly: Sequence[int], low: int, high: int, below: int, above: int, want: int
) -> list[tuple[int, int, int]]:
    """Disjoint (low, high] with their root counts, largest first; each holds one root or
    has length 1. ``below`` and ``above`` are the roots greater than ``low`` and ``high``.
    Stops once ``want`` roots are covered."""
    out, covered = [], 0
    stack = [(low, high, below, above)]
    while stack and covered < want:
        low, high, below, above = stack.pop()
        if below == above:
            continue
        if below - above == 1 or high - low == 1:
            out.append((low, high, below - above))
            covered += below - above
            continue
        middle = (low + high) // 2
        count = roots_above(poly, middle)
        stack += [(low, middle, below, count), (middle, high, count, above)]
    return out


def refined(poly: Sequence[int], low: int, high: int, bits: int = BITS) -> tuple[int, int]:
    """The only root in (low, high] as ``(numerator, bits)``, with ``bits`` significant bits."""
    while True:
        fine, a, b = scaled(poly, bits), low << bits, high << bits
        side = _sign(fine, b)
        while side and b - a > 1:
            middle = (a + b) // 2
            here = _sign(fine, middle)
            if here == 0:
                a, b, side = middle - 1, middle, 0
            elif here == side:
                b = middle
            else:
                a = middle
        if b.bit_length() >= BITS:
            return b, bits
        bits *= 2


def largest_roots(poly: Sequence[int], bound: int, want: int) -> list[tuple[int, int]]:
    """The ``want`` largest positive roots as ``(numerator, bits)``, repeated by multiplicity."""
    found: list[tuple[int, int]] = []
    for low, high, count in isolated(poly, 0, bound, roots_above(poly, 0), 0, want):
        if count == 1:
            found.append(refined(poly, low, high))
            continue
        # Several roots between two neighbouring whole numbers: apart by less, or equal.
        fine = scaled(poly, 2 * BITS)
        a, b = low << (2 * BITS), high << (2 * BITS)
        for _, top, times in isolated(fine, a, b, roots_above(fine, a), roots_above(fine, b), count):
            if times == 1:
                # Refined on the polynomial as it is between the fine neighbours.
                found.append(_refined_fine(fine, _, top))
            else:
                found.extend([(top, 2 * BITS)] * times)
    return found[:want]


def _refined_fine(fine: Sequence[int], low: int, high: int) -> tuple[int, int]:
    numerator, bits = refined(fine, low, high, 1)
    return numerator, bits + 2 * BITS


# --- components ---------------------------------------------------------------------------


def null_vectors(matrix: Sequence[Sequence[int]], root: tuple[int, int], count: int) -> list[np.ndarray]:
    """``count`` orthogonal unit vectors that ``matrix`` minus ``root`` takes to zero.

    Gaussian elimination with pivots in fixed-point whole numbers, then inverse iteration;
    later vectors are kept orthogonal to the ones found.
    """
    numerator, bits = root
    d, f = len(matrix), bits + GUARD
    one = 1 << f
    a = np.array([[v << f for v in row] for row in matrix], object).reshape(d, d)
    for i in range(d):
        a[i, i] -= numerator << (f - bits)
    order = []
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        order.append(pivot)
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # the smallest step there is
        if k + 1 < d:
            factor = (a[k + 1 :, k] << f) // a[k, k]
            a[k + 1 :, k] = factor
            a[k + 1 :, k + 1 :] -= np.multiply.outer(factor, a[k, k + 1 :]) >> f

    def solved(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for k, pivot in enumerate(order):
            x[[k, pivot]] = x[[pivot, k]]
            x[k + 1 :] -= a[k + 1 :, k] * x[k] >> f
        for k in range(d - 1, -1, -1):
            x[k] = ((x[k] - (int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> f)) << f) // a[k, k]
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        length = math.isqrt(int((x * x).sum()))
        return (x << f) // max(length, 1)

    found: list[np.ndarray] = []
    for number in range(count):
        x = np.array([one + (i * 7919 + number * 104_729) % 1009 * (one >> 11) for i in range(d)], object)
        x[number % d] += one * (number + 1)
        for _ in range(3):
            x = unit(solved(x))
            for _ in range(2):
                for other in found:
                    x = x - (other * (int((x * other).sum()) >> f) >> f)
                x = unit(x)
        found.append(x)
    out = []
    for x in found:
        v = np.array([math.ldexp(float(int(e) >> (f - 120)), -120) for e in x])
        out.append(v if v[np.abs(v).argmax()] > 0 else -v)
    return out


def spectrum(vectors: DataFrame, components: int = COMPONENTS) -> Spectrum:
    """The largest roots of the scatter and their components; none where nothing varies."""
    spark = vectors.sparkSession
    rows, sums, matrix = scatter(vectors)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return Spectrum(rows, sums, trace, [], np.zeros((0, len(matrix))))
    poly = characteristic_polynomial(spark, matrix)
    roots = largest_roots(poly, trace, components)
    distinct = list(dict.fromkeys(roots))
    wanted = [(i, str(r[0]), r[1], roots.count(r)) for i, r in enumerate(distinct)]

    def iterated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, a, bits, n in batch.itertuples(index=False):
                out += [(i, v) for v in null_vectors(matrix, (int(a), int(bits)), int(n))]
            yield pd.DataFrame(out, columns=["i", "v"])

    lines = (
        spark.createDataFrame(wanted, "i int, a string, bits int, n int")
        .repartition(len(wanted), "i")
        .mapInPandas(iterated, "i int, v array<double>")
        .collect()  # at most ``components`` rows
    )
    vectors_found = [line["v"] for line in sorted(lines, key=lambda line: line["i"])]
    return Spectrum(rows, sums, trace, roots, np.array(vectors_found))


# --- whitened rows --------------------------------------------------------------------------


def _centred(x: np.ndarray, fit: Spectrum) -> np.ndarray:
    """``n * x - S``, exact."""
    top = max(int(x.max()), -int(x.min()))
    if fit.rows * top + max(map(abs, fit.sums)) < 2**62:
        return x * fit.rows - np.array(fit.sums, np.int64)
    return x.astype(object) * fit.rows - np.array(fit.sums, object)


def _whiten(x: np.ndarray, fit: Spectrum) -> tuple[list[int | None], np.ndarray]:
    """Deviation and whitened values per row."""
    centred = _centred(x, fit)
    real = centred.astype(np.float64)
    if centred.dtype == object or (real * real).sum(axis=1).max() > 2.0**62:
        deviation = [int((row * row).sum()) for row in centred.astype(object)]
        deviation = [v if v < 2**63 else None for v in deviation]
    else:
        deviation = (centred * centred).sum(axis=1).tolist()
    weights = fit.vectors.T / np.sqrt(fit.variances())
    return deviation, (real / fit.rows) @ weights


def whitened_arrays(vectors: DataFrame, fit: Spectrum) -> DataFrame:
    """``_id`` with ``_w``: the exact deviation and one whitened value per component."""

    def whiten(x: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"deviation": pd.Series([], dtype="Int64"), "values": []})
        deviation, values = _whiten(_matrix(x), fit)
        return pd.DataFrame(
            {"deviation": pd.array(deviation, dtype="Int64"), "values": list(values)}
        )

    schema = "deviation bigint, values array<double>"
    return vectors.select("_id", F.pandas_udf(whiten, schema)("_x").alias("_w"))


def identity_error(vectors: DataFrame, fit: Spectrum) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(fit.roots)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, len(batch), _CHUNK):
                _, w = _whiten(_matrix(batch["_x"].iloc[at : at + _CHUNK]), fit)
                total += w.sum(axis=0)
                square += w.T @ w
        rows = [(-1, j, total[j]) for j in range(k)]
        rows += [(i, j, square[i, j]) for i in range(k) for j in range(k)]
        yield pd.DataFrame(rows, columns=["i", "j", "v"])

    lines = (
        vectors.select("_x")
        .mapInPandas(moments, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()  # one row per pair of components
    )
    mean, square = np.zeros(k), np.zeros((k, k))
    for i, j, v in lines:
        if i < 0:
            mean[j] = v / fit.rows
        else:
            square[i, j] = v / fit.rows
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whitened(
    table: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null or empty, holds null or an entry that is not finite (or
    beyond 2**56, whose scaled value is no long), or has another length than most, are
    left out of everything. Repeated rows count as rows; a null vec_id stays null. Equal
    eigenvalues get orthogonal components of their common space. Components without
    variance have no rows, so a table without any variance, an empty one included, gives
    an empty result. A deviation beyond a long is null. Other columns are not looked at.
    """
    vectors = whole_vectors(table, vector, vec_id)
    fit = spectrum(vectors, components)
    if fit.roots:
        error = identity_error(vectors, fit)
        arrays, explained = whitened_arrays(vectors, fit), fit.explained()
    else:
        error, explained = 0.0, [0.0]
        nothing = F.struct(
            F.lit(0).cast("bigint").alias("deviation"),
            F.array(F.lit(0.0)).alias("values"),
        )
        arrays = vectors.where("false").select("_id", nothing.alias("_w"))
    shares: Column = F.array(*[F.lit(v) for v in explained])
    return arrays.select(
        "_id", F.col("_w.deviation").alias("deviation"), F.posexplode("_w.values").alias("_k", "w")
    ).select(
        F.col("_id").alias("vec_id"),
        (F.col("_k") + 1).alias("component"),
        F.lit(fit.rows).cast("bigint").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.get(shares, F.col("_k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
