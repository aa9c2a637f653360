"""Embedding whitening from the exact characteristic polynomial of the integer scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import save
from .vectors import finite, matrix, padded

STEPS = 256
COMPONENTS = 4
#: Bits behind the point of the roots, and of the null-space arithmetic beyond those.
ROOT_BITS, SPARE_BITS = 96, 192
#: Entries below this and so many rows at once: sums of products stay below 2**53, where doubles are exact.
_SMALL, _ROWS = 1 << 20, 4096
_LIMB = 40


def steps_of(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """id_col and x, the vectors in whole steps of 1/256, of rows with finite vectors; and the number of dimensions.

    Steps beyond a 64-bit integer stay at its ends. Vectors shorter than the longest get zeros behind.
    """
    rows = df.filter(finite(vector_col)).select(F.col(id_col), F.transform(vector_col, lambda c: F.floor(c.cast("double") * STEPS).cast("long")).alias("x"))
    return padded(rows, "x")


def _limbs(values: list[int]) -> list[list[int]]:
    """Three columns of 40-bit digits, the last with the sign: such digits can be added up as 64-bit numbers."""
    mask = (1 << _LIMB) - 1
    return [[v & mask for v in values], [(v >> _LIMB) & mask for v in values], [v >> 2 * _LIMB for v in values]]


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and sums of products of x over the fit list, as exact integers.

    Each task sends one row for each pair of dimensions, however many vectors it holds.
    """
    at = np.triu_indices(dims)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(dims, object), np.zeros(len(at[0]), object)
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                x = matrix(batch.column(0).slice(a, _ROWS), dims, np.int64)
                count += len(x)
                if len(x) and max(int(x.max()), -int(x.min())) < _SMALL:
                    exact = x.astype(np.float64)
                    sums = sums + exact.sum(0).astype(np.int64).astype(object)
                    products = products + (exact.T @ exact)[at].astype(np.int64).astype(object)
                else:
                    big = x.astype(object)
                    sums = sums + big.sum(0)
                    products = products + big.T.dot(big)[at]
        values = [count, *map(int, sums), *map(int, products)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), *(pa.array(c, pa.int64()) for c in _limbs(values))], ["entry", "d0", "d1", "d2"])

    parts = fit.select("x").mapInArrow(partial, "entry int, d0 long, d1 long, d2 long")
    rows = sorted(parts.groupBy("entry").agg(*(F.sum(c).alias(c) for c in ("d0", "d1", "d2"))).collect())
    values = [r.d0 + (r.d1 << _LIMB) + (r.d2 << 2 * _LIMB) for r in rows] or [0] * (1 + dims + len(at[0]))
    full = np.zeros((dims, dims), object)
    full[at] = values[1 + dims :]
    full.T[at] = values[1 + dims :]
    return values[0], values[1 : 1 + dims], full


def _is_prime(n: int) -> bool:
    """Miller-Rabin to bases that decide every number below 2**32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes downwards from 2**31 whose product is above the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Characteristic polynomial of an integer matrix modulo a prime below 2**31, constant first, through Hessenberg form."""
    h = (a % p).astype(np.int64)
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    lead = np.zeros((d + 1, d + 1), np.int64)  # of the leading blocks
    lead[0, 0] = 1
    for k in range(1, d + 1):
        weight, step = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weight[i] = int(h[i, k - 1]) * step % p
            step = step * int(h[i, i - 1]) % p if i else step
        lead[k, 1:] = lead[k - 1, :-1]
        lead[k] = (lead[k] - (weight[:, None] * lead[:k] % p).sum(0)) % p
    return lead[d]


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Coefficients of det(x - a), constant first, of a symmetric integer matrix without negative eigenvalues.

    Tasks take the polynomial modulo primes; the remainders, bounded by the number of dimensions, are
    put together here. The signs alternate, and all sizes together are at most (1 + trace/d)**d.
    """
    d = len(a)
    if not d:
        return [1]
    primes = primes_beyond((1 + -(-int(np.trace(a)) // d)) ** d)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([polynomial_mod(a, primes[i]).tolist() for i in at], pa.list_(pa.int64()))], ["at", "c"])

    parts = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, parts).mapInArrow(tasks, "at long, c array<long>").collect()
    whole = math.prod(primes)
    sizes = [0] * (d + 1)
    for r in rows:
        p = primes[r.at]
        other = whole // p
        unit = other * pow(other, -1, p)
        for k, c in enumerate(r.c):
            sizes[k] += (c if (d - k) % 2 == 0 else -c) % p * unit
    return [v % whole * (-1) ** (d - k) for k, v in enumerate(sizes)]


def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots, by multiplicity, lie above at / 2**bits.

    By the rule of signs on the polynomial moved to that point, which is exact as all roots are real.
    """
    d = len(poly) - 1
    c = [v << bits * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> list[int]:
    """The largest positive roots, by multiplicity and falling: root r is told from all others by r / 2**bits < root <= (r + 1) / 2**bits."""
    found: list[int] = []
    top = 1 << (-poly[-2] if len(poly) > 1 else 0).bit_length()  # the sum of the roots is not above it
    positive = roots_above(poly, 0, 0)
    for k in range(1, min(count, positive) + 1):
        low, high, point = 0, top, 0
        if found and roots_above(poly, found[-1], bits) >= k:
            found.append(found[-1])
            continue
        while high - low > 1:  # first between whole numbers, then on finer grids, which cost more
            mid = (low + high) // 2
            low, high = (mid, high) if roots_above(poly, mid, point) >= k else (low, mid)
            if high - low == 1 and point < bits:
                step = min(32, bits - point)
                low, high, point = low << step, high << step, point + step
        if point < bits:  # the sum is 1: no step was taken
            low, high = low << bits, high << bits
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if roots_above(poly, mid, bits) >= k else (low, mid)
        found.append(low)
    return found


def _factored(a: np.ndarray, root: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triangular factors, with the order of rows, of a - root in fixed point."""
    scale = bits + SPARE_BITS
    f = a * (1 << scale)
    d = len(f)
    f[np.arange(d), np.arange(d)] -= ((2 * root + 1) << SPARE_BITS) >> 1
    order, times = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        i = k + max(range(d - k), key=lambda j: abs(f[k + j, k]))
        f[[i, k]], times[[i, k]], order[[i, k]] = f[[k, i]], times[[k, i]], order[[k, i]]
        f[k, k] = f[k, k] or 1
        times[k + 1 :, k] = (f[k + 1 :, k] * (1 << scale)) // f[k, k]
        f[k + 1 :, k:] -= (times[k + 1 :, k, None] * f[k, k:]) >> scale
    return f, times, order


def _unit(v: np.ndarray, scale: int) -> np.ndarray:
    return (v * (1 << scale)) // max(1, math.isqrt(int((v * v).sum())))


def components_of(a: np.ndarray, roots: list[int], bits: int = ROOT_BITS) -> np.ndarray:
    """Unit eigenvectors as rows, by inverse iteration in the null space of a - root in fixed point.

    A repeated root gets vectors at right angles to one another.
    """
    d, scale = len(a), bits + SPARE_BITS
    out: list[np.ndarray] = []
    for i, root in enumerate(roots):
        same = [out[j] for j in range(i) if roots[j] == root]
        upper, times, order = _factored(a, root, bits)
        v = _unit(np.array([pow(3 + i, j + 1, 1009) + 1 for j in range(d)], object), scale)
        for _ in range(3):
            y = v[order]
            for k in range(d):
                y[k + 1 :] -= (times[k + 1 :, k] * y[k]) >> scale
            for k in range(d - 1, -1, -1):
                y[k] = (y[k] << scale) // upper[k, k]
                y[:k] -= (upper[:k, k] * y[k]) >> scale
            v = _unit(y, scale)
            for w in same:
                v = _unit(v - ((int((v * w).sum()) >> scale) * w >> scale), scale)
        out.append(v)
    return np.array([[int(x) / (1 << scale) for x in v] for v in out], np.float64).reshape(len(out), d)


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id_col, component, n, deviation, whitened, explained, identity_error: a row for each row with a finite vector and component.

    Vectors become whole steps of 1/256. Each distinct one counts once in the covariance, whose integer
    form n * sum(x x') - S S' is gathered exactly, as is its characteristic polynomial; the largest roots
    are isolated by counts of signs and refined to ROOT_BITS bits behind the point, their vectors come
    from inverse iteration in fixed point. What the driver holds depends on the number of dimensions alone.

    Rows whose vector is null or holds a null, a NaN or an infinity are left out. Shorter vectors get zeros
    behind. Null, repeated and tied ids are kept row by row, other columns are not looked at. Components
    whose eigenvalue is zero cannot be scaled and are left out, so that an empty table, one with a single
    distinct vector, or one of empty vectors gives no rows. A deviation beyond 64 bits is null.
    """
    spark = df.sparkSession
    names = f"{id_col} {df.schema[id_col].dataType.simpleString()}"
    kind = df.schema[id_col].dataType
    schema = f"{names}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, dims = steps_of(df, id_col, vector_col)
    if not dims:
        return spark.createDataFrame([], schema)
    fit = save(rows.select("x").distinct())
    n, sums, products = moments(fit, dims)
    scatter = products * n - np.outer(np.array(sums, object), np.array(sums, object))
    shared = math.gcd(*map(int, scatter.ravel()))
    if not shared:
        return spark.createDataFrame([], schema)
    reduced = scatter // shared
    roots = largest_roots(characteristic_polynomial(spark, reduced), components)
    axes = components_of(reduced, roots)
    trace = int(np.trace(reduced))
    middle = [2 * r + 1 for r in roots]
    explained = [m / (trace << (ROOT_BITS + 1)) for m in middle]
    # a whitened value is (n * x - S) on its axis, over n * sqrt(e) where n * n * e is the scatter's eigenvalue
    lengths = np.array([math.sqrt((m * shared) / (1 << (ROOT_BITS + 1))) for m in middle])
    weights = (axes / lengths[:, None]).T
    mean = np.array(sums, object)
    widest = max(abs(v) for v in sums)

    def moved(x: np.ndarray) -> np.ndarray:
        most = max(int(x.max()), -int(x.min())) if x.size else 0
        if dims * (n * most + widest) ** 2 < 1 << 63:
            return x * n - mean.astype(np.int64)
        return x.astype(object) * n - mean

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = moved(matrix(batch.column(batch.num_columns - 1), dims, np.int64))
            squares = [int(v) for v in (y * y).sum(1)]
            values = y.astype(np.float64) @ weights
            far = pa.array([v if v < 1 << 63 else None for v in squares], pa.int64())
            out = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(roots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], far, out], [*batch.schema.names[:-1], "deviation", "w"])

    over = fit.select("x").mapInArrow(projected, "deviation long, w array<double>")
    pairs = [(i, j) for i in range(len(roots)) for j in range(i + 1)]
    found = over.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs))).first()
    error = max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))

    parts = rows.select(F.col(id_col), "x").mapInArrow(projected, f"{names}, deviation long, w array<double>")
    each = parts.select(F.col(id_col), "deviation", F.posexplode("w").alias("at", "whitened"))
    shares = F.array(*map(F.lit, explained))
    return each.select(
        F.col(id_col).cast(kind), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every row of embeddings."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
