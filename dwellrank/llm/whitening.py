"""Whitening of embeddings from the exact characteristic polynomial of their scatter matrix.

Entries become whole numbers, so sums and the scatter matrix ``n * sum(x x') - s s'`` are exact. Its
characteristic polynomial is worked out modulo many primes by reduction to Hessenberg form and put
together by Chinese remainders. All roots are real, so the signs of the Taylor coefficients at a point
count the roots beyond it (Budan's theorem is exact then): bisection isolates the largest roots for
certain, at any distance of their neighbours, and gives their multiplicity. Components come from inverse
iteration on the null space of ``scatter - root``, in whole numbers of as many bits as the gap to the next root
asks for, and are rounded to doubles at the very end.

Vectors are read by Spark tasks in Arrow batches: one pass for the sums, one for the whitened covariance, one
for the result; no vector is shuffled. The driver gets sums, whose number depends on the dimension alone.
Primes and roots are dealt out to tasks as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.session import pin

SCALE, SHIFT = 1024, 100_000  # x = floor(SCALE * c) + SHIFT
COMPONENTS = 8
ROWS = 4096  # vectors a numpy pass looks at
LIMB = 30  # bits of a partial sum that travel in one number
PRIMES_PER_TASK = 16
_LONG = 1 << 63


# --- exact sums --------------------------------------------------------------------------------------


def usable(column: str = "embedding") -> str:
    """SQL condition: not null, and every entry a finite number."""
    return f"{column} is not null and forall({column}, c -> c is not null and not isnan(c) and abs(c) < double('inf'))"


def whole_entries(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) of a list array without nulls, vectors x dims; beyond a long it ends at its limits."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.floor(flat * SCALE)
    # The shift must fit as well; 2**63 - 2**18 is a double.
    return np.clip(found, -float(_LONG), float(_LONG - (1 << 18))).astype(np.int64).reshape(-1, dims)


def _limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Signed limbs of whole numbers, lowest first; the last one takes the sign."""
    out = []
    while len(out) == 0 or np.any(values):
        low = values & ((1 << bits) - 1)
        high = values >> bits
        if np.all((high == 0) | (high == -1)) and np.all(np.abs(values) < (1 << bits)):
            out.append(values)
            break
        out.append(low)
        values = high
    return out


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers, by exact products of limbs in doubles."""
    bits = 20
    parts = [x.astype(np.float64) for x in _limbs(y, bits)]  # below 2**20, so 4096 products stay below 2**53
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) << (bits * (i + j))
    return total


def _partial_sums(dims: int):
    """Per task: rows (entry, limb, value). Entry 0 counts vectors, then sums, then products above the diagonal."""
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            y = whole_entries(batch.column(0), dims)
            for at in range(0, len(y), ROWS):
                part = y[at : at + ROWS]
                n += len(part)
                # Halves, so that the sum of 4096 longs is exact.
                sums += (part >> 32).sum(axis=0).astype(object) * (1 << 32) + (part & 0xFFFFFFFF).sum(axis=0).astype(object)
                products += exact_products(part)
        if not n:
            return
        entry, limb, value = [], [], []
        for i, x in enumerate([n, *sums, *products[upper]]):
            sign, x, k = (-1 if x < 0 else 1), abs(int(x)), 0
            while x:
                entry.append(i)
                limb.append(k)
                value.append(sign * (x & ((1 << LIMB) - 1)))
                x, k = x >> LIMB, k + 1
        yield pa.RecordBatch.from_arrays([pa.array(entry, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())], ["entry", "limb", "value"])

    return run


class Moments(NamedTuple):
    """Number of vectors, sums of y = x - SHIFT, and n**2 times the covariance, all exact."""

    n: int
    sums: list[int]
    scatter: list[list[int]]


def moments(vectors: DataFrame, dims: int) -> Moments:
    """Exact moments of the one column of ``vectors``, usable arrays of ``dims`` entries."""
    partial = vectors.mapInArrow(_partial_sums(dims), "entry int, limb int, value long")
    found = [0] * (1 + dims + dims * (dims + 1) // 2)
    for row in partial.groupBy("entry", "limb").agg(F.sum("value").alias("value")).collect():
        found[row.entry] += row.value << (LIMB * row.limb)
    n, sums = found[0], found[1 : dims + 1]
    scatter = [[0] * dims for _ in range(dims)]
    for i, j, x in zip(*np.triu_indices(dims), found[dims + 1 :]):
        scatter[i][j] = scatter[j][i] = n * x - sums[i] * sums[j]
    return Moments(n, sums, scatter)


# --- the characteristic polynomial -------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 3,215,031,751."""
    if n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(limit: int, product: int) -> list[int]:
    """The largest primes below ``limit`` whose product is more than ``product``."""
    found, total, n = [], 1, limit
    while total <= product:
        n -= 1
        if _is_prime(n):
            found.append(n)
            total *= n
    return found


def hessenberg_polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime, lowest first; all primes go through each step at once."""
    d, big = len(matrix), np.array(matrix, object)
    p = np.array(primes, np.int64)
    h = np.stack([(big % q).astype(np.int64) for q in primes])
    m1, m2 = p[:, None], p[:, None, None]
    for j in range(d - 2):
        below = h[:, j + 1 :, j] != 0
        first = below.argmax(axis=1)
        for k in np.flatnonzero(below.any(axis=1) & (first > 0)):
            a, b = j + 1, j + 1 + int(first[k])
            h[k][[a, b]] = h[k][[b, a]]
            h[k][:, [a, b]] = h[k][:, [b, a]]
        pivot = np.array([pow(int(x), -1, int(q)) if x else 0 for x, q in zip(h[:, j + 1, j], p)], np.int64)
        u = h[:, j + 2 :, j] * pivot[:, None] % m1
        h[:, j + 2 :, :] = (h[:, j + 2 :, :] - u[:, :, None] * h[:, j + 1, None, :] % m2) % m2
        h[:, :, j + 1] = (h[:, :, j + 1] + (h[:, :, j + 2 :] * u[:, None, :] % m2).sum(axis=2)) % m1
    polynomials = np.zeros((d + 1, len(p), d + 1), np.int64)
    polynomials[0, :, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros((len(p), d + 1), np.int64)
        now[:, 1:] = polynomials[k - 1][:, :-1]
        now = (now - h[:, k - 1, k - 1, None] * polynomials[k - 1] % m1) % m1
        chain = np.ones(len(p), np.int64)
        for i in range(1, k):
            chain = chain * h[:, k - i, k - i - 1] % p
            now = (now - (h[:, k - i - 1, k - 1] * chain % p)[:, None] * polynomials[k - i - 1] % m1) % m1
        polynomials[k] = now
    return polynomials[d]


def _common_divisor(f: list[int], g: list[int], p: int) -> list[int]:
    """Monic greatest common divisor modulo p, lowest coefficient first."""
    while g and not g[-1]:
        g = g[:-1]
    while g:
        inverse = pow(g[-1], -1, p)
        g = [x * inverse % p for x in g]
        f = list(f)
        while len(f) >= len(g):
            top, shift = f[-1], len(f) - len(g)
            if top:
                for i, x in enumerate(g):
                    f[shift + i] = (f[shift + i] - top * x) % p
            f.pop()
        while f and not f[-1]:
            f.pop()
        f, g = g, f
    return f


def _residues(matrix: list[list[int]]):
    """Per prime: the characteristic polynomial and its common divisor with its derivative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            primes = batch.column(0).to_pylist()
            for at in range(0, len(primes), PRIMES_PER_TASK):
                part = primes[at : at + PRIMES_PER_TASK]
                rows = hessenberg_polynomials(matrix, part).tolist()
                shared = [_common_divisor(f, [i * x % p for i, x in enumerate(f)][1:], p) for f, p in zip(rows, part)]
                yield pa.RecordBatch.from_pydict({"p": pa.array(part, pa.int64()), "f": pa.array(rows, pa.list_(pa.int64())), "g": pa.array(shared, pa.list_(pa.int64()))})

    return run


def remaindered(residues: list[list[int]], primes: list[int]) -> list[int]:
    """Whole numbers, least in absolute value, with the given residues."""
    product = math.prod(primes)
    out = [0] * len(residues[0])
    for row, p in zip(residues, primes):
        rest = product // p
        weight = rest * pow(rest, -1, p)
        for i, x in enumerate(row):
            out[i] += weight * x
    return [x - product if 2 * x > product else x for x in (x % product for x in out)]


def _product_bound(matrix: list[list[int]]) -> int:
    """More than twice any coefficient of the polynomial of a positive semidefinite matrix, or of a factor.

    The k-th elementary symmetric sum of non-negative roots is at most C(d, k) (trace / d)**k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    return 2 * max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1)) + 2


def polynomials(spark: SparkSession, matrix: list[list[int]]) -> tuple[list[int], list[int]]:
    """det(x - matrix) and its divisor that holds each root but once, lowest coefficient first.

    Each prime is a task's row: its residues are d + 1 numbers, and the number of primes follows from
    the matrix alone. A prime modulo which roots fall together that are apart in truth has a longer common divisor
    and is left out of that; the primes are asked for anew, with more of them, if too few stay.
    """
    bound = _product_bound(matrix)
    while True:
        primes = primes_below(1 << 31, bound << 62)
        tasks = -(-len(primes) // PRIMES_PER_TASK)
        dealt = spark.range(0, len(primes), 1, tasks).select(F.element_at(F.lit(primes), F.col("id").cast("int") + 1).alias("p"))
        rows = sorted(map(tuple, dealt.mapInArrow(_residues(matrix), "p long, f array<long>, g array<long>").collect()))
        whole = remaindered([f for _, f, _ in rows], [p for p, _, _ in rows])
        shortest = min(len(g) for _, _, g in rows)
        fit = [(p, g) for p, _, g in rows if len(g) == shortest]
        if math.prod(p for p, _ in fit) > bound:
            return whole, _quotient(whole, remaindered([g for _, g in fit], [p for p, _ in fit]))
        bound <<= 31 * len(primes)


def _quotient(f: list[int], g: list[int]) -> list[int]:
    """f / g for a monic g that divides f."""
    f, out = list(f), [0] * (len(f) - len(g) + 1)
    for i in reversed(range(len(out))):
        out[i] = f[i + len(g) - 1]
        for j, x in enumerate(g):
            f[i + j] -= out[i] * x
    return out


# --- roots -------------------------------------------------------------------------------------------


def roots_beyond(f: list[int], a: int, k: int) -> int:
    """Number of roots of f above a / 2**k, each as often as it is one, for f with real roots only."""
    d = len(f) - 1
    c = [x << (k * (d - i)) for i, x in enumerate(f)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value_sign(f: list[int], a: int, k: int) -> int:
    total, scale = 0, 0
    for x in reversed(f):
        total = total * a + (x << scale)
        scale += k
    return (total > 0) - (total < 0)


class Root(NamedTuple):
    """A root in (low, low + 1] / 2**bits and its multiplicity."""

    low: int
    bits: int
    count: int


def largest_roots(f: list[int], simple: list[int], most: int, precision: int = 160) -> list[Root]:
    """The largest positive roots, falling, until their multiplicities reach ``most``.

    ``f`` has real roots from 0 on, ``simple`` the same ones but once each. Bisection of the line, upper halves
    first, ends when an interval holds one root. It is then narrowed by the sign of ``simple`` until all other
    roots are 2**precision times its width away.
    """
    while len(simple) > 1 and not simple[0]:
        simple = simple[1:]  # the root 0
    if len(simple) == 1:
        return []
    trace = abs(f[-2])
    # Intervals (low, high] / 2**k with the roots beyond their ends, the largest on top of the pile.
    high = 1 << trace.bit_length()
    pile, out, held = [(0, high, 0, len(simple) - 1, 0)], [], 0
    while pile and held < most:
        low, high, k, from_low, from_high = pile.pop()
        if from_low == from_high:
            continue
        if high - low > 1 and from_low - from_high == 1:
            low, high = _bisected(simple, low, high, k)
        if high - low == 1 and from_low - from_high == 1:
            count = roots_beyond(f, low, k) - roots_beyond(f, high, k)
            out.append(Root(*_apart(simple, low, k, precision), count))
            held += count
            continue
        if high - low == 1:
            low, high, k = 2 * low, 2 * high, k + 1
        mid = (low + high) // 2
        from_mid = roots_beyond(simple, mid, k)
        pile += [(low, mid, k, from_low, from_mid), (mid, high, k, from_mid, from_high)]
    return out


def _bisected(simple: list[int], low: int, high: int, k: int) -> tuple[int, int]:
    """(low, high] with one simple root, narrowed to a width of one."""
    above = _value_sign(simple, high, k)
    if not above:
        return high - 1, high
    while high - low > 1:
        mid = (low + high) // 2
        here = _value_sign(simple, mid, k)
        if not here:
            return mid - 1, mid
        low, high = (low, mid) if here == above else (mid, high)
    return low, high


def _apart(simple: list[int], low: int, k: int, precision: int) -> tuple[int, int]:
    """The interval of one root, so narrow that the next roots are 2**precision of its widths away."""
    bits = k + precision
    while True:
        low, k = _refined(simple, low, k, bits)
        reach = 1 << precision
        if roots_beyond(simple, max(low - reach, 0), k) - roots_beyond(simple, low + 1 + reach, k) == 1:
            return low, k
        bits += precision


def _refined(simple: list[int], low: int, k: int, bits: int) -> tuple[int, int]:
    """The interval (low, low + 1] / 2**k with one simple root, narrowed to 2**-bits."""
    above = _value_sign(simple, low + 1, k)
    if not above:
        return ((low + 1) << max(bits - k, 0)) - 1, max(bits, k)
    while k < bits:
        low, k = 2 * low, k + 1
        here = _value_sign(simple, low + 1, k)
        if here == 0:
            return ((low + 1) << (bits - k)) - 1, bits
        if here != above:
            low += 1
    return low, k


# --- components --------------------------------------------------------------------------------------


def null_space(matrix: list[list[int]], low: int, bits: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of matrix - root, by inverse iteration.

    Whole numbers throughout: entries in units of 2**-bits, factors and vectors in units of 2**-guard.
    """
    d = len(matrix)
    a = np.array(matrix, object) * (1 << bits)
    for i in range(d):
        a[i, i] -= low
    guard = bits + max(abs(x) for row in matrix for x in row).bit_length() + 64
    order, factors = np.arange(d), []
    for j in range(d):
        pivot = j + max(range(d - j), key=lambda i: abs(a[j + i, j]))
        a[[j, pivot]], order[[j, pivot]] = a[[pivot, j]], order[[pivot, j]]
        for f in factors:
            f[[j, pivot]] = f[[pivot, j]]
        if not a[j, j]:
            a[j, j] = 1  # less than any unit that counts
        f = np.zeros(d, object)
        f[j + 1 :] = (a[j + 1 :, j] * (1 << guard)) // a[j, j]
        a[j + 1 :, j:] -= (f[j + 1 :, None] * a[None, j, j:]) >> guard
        factors.append(f)
    found: list[np.ndarray] = []
    seed = np.random.default_rng(11)
    for _ in range(count):
        v = np.array([int(x) for x in seed.integers(1 << 30, 1 << 31, d)], object) << (guard - 31)
        for _ in range(3):
            v = _without(v, found, guard)
            b = v[order]
            for j in range(d):
                b = b - ((factors[j] * b[j]) >> guard)
            x = np.zeros(d, object)
            for j in reversed(range(d)):
                x[j] = (((b[j] - ((a[j, j + 1 :] * x[j + 1 :]).sum() >> guard if j + 1 < d else 0)) << guard)) // a[j, j]
            v = _unit(x, guard)
        found.append(_unit(_without(v, found, guard), guard))
    return [[x / (1 << guard) for x in v] for v in found]


def _without(v: np.ndarray, others: list[np.ndarray], guard: int) -> np.ndarray:
    for u in others:
        v = v - ((u * ((u * v).sum() >> guard)) >> guard)
    return v


def _unit(v: np.ndarray, guard: int) -> np.ndarray:
    """v at length 2**guard."""
    size = math.isqrt(int((v * v).sum())) or 1
    return (v * (1 << guard)) // size


class Component(NamedTuple):
    eigenvalue: float
    explained: float
    vector: list[float]


def components(spark: SparkSession, found: Moments, most: int = COMPONENTS) -> list[Component]:
    """Unit eigenvectors of the covariance by falling eigenvalue; those of eigenvalue 0 are left out."""
    trace = sum(found.scatter[i][i] for i in range(len(found.scatter)))
    if not trace:
        return []
    whole, simple = polynomials(spark, found.scatter)
    roots = largest_roots(whole, simple, most)
    matrix = found.scatter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                root = roots[i]
                vectors = null_space(matrix, 2 * root.low + 1, root.bits + 1, root.count)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i] * len(vectors), pa.int64()), "vector": pa.array(vectors, pa.list_(pa.float64()))})

    # One task per root; at most ``most`` of them.
    rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(run, "id long, vector array<double>").collect()
    out = []
    for row in sorted(rows, key=lambda r: r.id):
        root = roots[row.id]
        value = 2 * root.low + 1
        scale = 1 << (root.bits + 1)
        out.append(Component(value / (scale * found.n**2), value / (scale * trace), row.vector))
    return out[:most]


# --- whitening ---------------------------------------------------------------------------------------


def centred(y: np.ndarray, found: Moments) -> np.ndarray:
    """n * y - s, exact: longs where they hold it, else Python integers."""
    most = max(int(abs(int(y.min()))), int(abs(int(y.max())))) if y.size else 0
    if found.n * most + max(map(abs, found.sums)) < _LONG:
        return found.n * y - np.array(found.sums, np.int64)
    return found.n * y.astype(object) - np.array(found.sums, object)


def deviations(gaps: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    most = np.abs(gaps).max(initial=0)
    if gaps.dtype != object and int(most) ** 2 * gaps.shape[1] < _LONG:
        return (gaps * gaps).sum(axis=1).tolist()
    if gaps.dtype != object and int(most) < 1 << 62 and gaps.shape[1] < 1 << 20:
        # Limbs of 21 bits: products of two have 42 at most.
        low, mid, high = gaps & 0x1FFFFF, (gaps >> 21) & 0x1FFFFF, gaps >> 42
        pairs = [(low, low, 0, 1), (low, mid, 21, 2), (mid, mid, 42, 1), (low, high, 42, 2), (mid, high, 63, 2), (high, high, 84, 1)]
        total = [0] * len(gaps)
        for a, b, shift, times in pairs:
            total = [t + (x * times << shift) for t, x in zip(total, (a * b).sum(axis=1).tolist())]
        return total
    return [int((row * row).sum()) for row in gaps.astype(object)]


def projected(y: np.ndarray, found: Moments, parts: list[Component]) -> tuple[np.ndarray, np.ndarray]:
    """Whitened vectors (rows x components) and n * y - s."""
    gaps = centred(y, found)
    basis = np.array([c.vector for c in parts]).T / np.sqrt([c.eigenvalue for c in parts])
    return (gaps.astype(np.float64) / found.n) @ basis, gaps


def identity_error(vectors: DataFrame, dims: int, found: Moments, parts: list[Component]) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity.

    Tasks centre by their own mean; the means are put together with the products by two small sums.
    """
    k = len(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = whole_entries(batch.column(0), dims)
            for at in range(0, len(y), ROWS):
                w, _ = projected(y[at : at + ROWS], found, parts)
                own = w.mean(axis=0)
                step = own - mean
                w -= own
                products += w.T @ w + np.outer(step, step) * (n * len(w) / (n + len(w)))
                mean += step * (len(w) / (n + len(w)))
                n += len(w)
        if n:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "mean": pa.array([mean.tolist()], pa.list_(pa.float64())), "products": pa.array([products.ravel().tolist()], pa.list_(pa.float64()))})

    partial = pin(vectors.mapInArrow(run, "n long, mean array<double>, products array<double>"), "whitened-moments")
    means = [r.mean for r in partial.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg((F.sum(F.col("n") * F.col("m")) / found.n).alias("mean")).orderBy("i").collect()]
    centre = F.lit(means)
    moved = F.get(F.col("mean"), (F.col("at") / k).cast("int")) - F.get(centre, (F.col("at") / k).cast("int"))
    other = F.get(F.col("mean"), F.col("at") % k) - F.get(centre, F.col("at") % k)
    entries = partial.select("n", "mean", F.posexplode("products").alias("at", "product")).groupBy("at").agg(
        (F.sum(F.col("product") + F.col("n") * moved * other) / found.n).alias("covariance")
    )
    apart = F.abs(F.col("covariance") - F.when(F.col("at") % (k + 1) == 0, 1.0).otherwise(0.0))
    return entries.agg(F.max(apart)).first()[0]


def whiten(embeddings: DataFrame, key: str = "vec_id", column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error, eigenvalue and deviation_exact.

    Vectors that are null or hold null or non-finite entries are dropped. Of vectors of several lengths those of
    the most frequent one are taken (of two, the longer); no others can have a covariance with them. Entries whose
    x does not fit a long count as the largest or smallest long that does, less a shift. ``deviation`` is null
    where it does not fit a long, ``deviation_exact`` (38 digits) where it does not fit that. Components of
    eigenvalue 0 cannot be scaled and are left out: there are as many as the vectors have dimensions that vary,
    8 at most, and no rows where all vectors are equal or none is left. Of equal eigenvalues any orthonormal
    vectors are taken, the same for all rows. Repeated or null keys are rows of their own. Other
    columns, whatever their names, are left out.
    """
    spark = embeddings.sparkSession
    good = embeddings.select(F.col(key).alias("key"), F.col(column).alias("v")).filter(usable("v"))
    result = f"key {good.schema['key'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, deviation_exact decimal(38,0)"
    lengths = good.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths.dims if lengths else 0
    good = good.filter(F.size("v") == dims)
    found = moments(good.select("v"), dims) if dims else None
    parts = components(spark, found, most) if found else []
    if not parts:
        return spark.createDataFrame([], result).withColumnRenamed("key", key)
    error = identity_error(good.select("v"), dims, found, parts)
    k = len(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                whitened, gaps = projected(whole_entries(rows.column("v"), dims), found, parts)
                size, spread = rows.num_rows, deviations(gaps)
                place = pa.array(np.repeat(np.arange(size), k))
                fits = pa.array([x if x < _LONG else None for x in spread], pa.int64())
                exact = pa.array([Decimal(x) if x < 10**38 else None for x in spread], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": rows.column("key").take(place),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        "n": pa.array(np.full(size * k, found.n, np.int64)),
                        "deviation": fits.take(place),
                        "whitened": pa.array(whitened.ravel()),
                        "explained": pa.array(np.tile([c.explained for c in parts], size)),
                        "identity_error": pa.array(np.full(size * k, error)),
                        "eigenvalue": pa.array(np.tile([c.eigenvalue for c in parts], size)),
                        "deviation_exact": exact.take(place),
                    }
                )

    return good.mapInArrow(run, result).withColumnRenamed("key", key)
