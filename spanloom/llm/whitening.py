"""Embedding whitening by the exact characteristic polynomial of an integer scatter.

Entries become whole numbers, so the scatter of all vectors is an exact integer
matrix. Tasks reduce it to Hessenberg form modulo one prime after another;
Chinese remaindering of their residues gives its characteristic polynomial.
Sign variations of shifted coefficients isolate the roots, which are all real;
Newton steps refine them to far more digits than a double has, and inverse
iteration in fixed-point integers gives the null space of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Bits of roots and null vectors below the largest root's first.
DIGITS = 240
#: Primes that a task takes in one block of arrays.
BLOCK = 16
#: Sums travel as limbs of so many bits, whose own sums fit a long.
LIMB = 40
_ROWS = 4096
_LIMIT = float(1 << 62)


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and their entries as floor(64 * c), one row each.

    A usable vector isn't null or empty and holds no null or non-finite entry.
    Values past a long are held at +-2**62.
    """
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.cast(pc.list_flatten(vectors), pa.float64()).to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    stop = np.cumsum(lengths)
    good = (lengths > 0) & (bad[stop] == bad[stop - lengths])
    sizes = np.unique(lengths[good])
    if len(sizes) > 1:
        raise ValueError(f"vectors have different lengths: {sizes[:4].tolist()}")
    rows = entries[np.repeat(good, lengths)].reshape(int(good.sum()), int(sizes[0]) if len(sizes) else 0)
    with np.errstate(over="ignore"):
        return good, np.clip(np.floor(SCALE * rows), -_LIMIT, _LIMIT).astype(np.int64)


def _largest(y: np.ndarray) -> int:
    return max(int(y.max()), -int(y.min())) if y.size else 0


def moments(embeddings: DataFrame, column: str = "embedding") -> tuple[int, np.ndarray, np.ndarray]:
    """Count, sums and sums of products of all usable vectors, as exact whole numbers of any size.

    Tasks send limbs of their sums, which Spark adds; the driver gets one row
    for each pair of dimensions and limb.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, None, None
        for batch in batches:
            _, rows = whole_numbers(batch.column(0))
            for at in range(0, len(rows), _ROWS):
                y = rows[at : at + _ROWS]
                small = _largest(y) ** 2 * len(y) < 1 << 53
                y = y.astype(np.float64) if small else y.astype(object)
                s, g = y.sum(0), y.T @ y
                if small:
                    s, g = s.astype(np.int64), g.astype(np.int64)
                if first is not None and len(s) != len(first):
                    raise ValueError(f"vectors have different lengths: {len(first)}, {len(s)}")
                n += len(y)
                first = s.astype(object) + (0 if first is None else first)
                second = g.astype(object) + (0 if second is None else second)
        if n:
            rest = np.concatenate([np.array([n], object), first, second[np.triu_indices(len(first))]])
            limb = 0
            while (rest != 0).any():
                last = all(-(1 << LIMB) < v < 1 << LIMB for v in rest)
                low = rest if last else rest & ((1 << LIMB) - 1)
                at = np.flatnonzero(low)
                yield pa.RecordBatch.from_arrays([pa.array([len(first)] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([limb] * len(at), pa.int32()), pa.array([int(v) for v in low[at]], pa.int64())], names=["d", "at", "limb", "v"])
                rest, limb = (rest * 0 if last else rest >> LIMB), limb + 1

    sums = embeddings.select(column).mapInArrow(run, "d int, at int, limb int, v long").groupBy("d", "at", "limb").agg(F.sum("v").alias("v")).collect()
    sizes = {r["d"] for r in sums}
    if len(sizes) > 1:
        raise ValueError(f"vectors have different lengths: {sorted(sizes)[:4]}")
    if not sums:
        return 0, np.zeros(0, object), np.zeros((0, 0), object)
    d = sizes.pop()
    flat = np.zeros(1 + d + d * (d + 1) // 2, object)
    for r in sums:
        flat[r["at"]] += r["v"] << LIMB * r["limb"]
    products = np.zeros((d, d), object)
    products[np.triu_indices(d)] = flat[1 + d :]
    return flat[0], flat[1 : 1 + d], np.where(np.tri(d, k=-1, dtype=bool), products.T, products)


def primes(count: int) -> list[int]:
    """The largest ``count`` primes below 2**31: their products fit a long."""
    small = np.ones(46_342, bool)
    small[:2] = False
    for i in range(2, 216):
        small[i * i :: i] &= not small[i]
    found, top, width = [], 1 << 31, 1 << 18
    while len(found) < count:
        window = np.ones(width, bool)
        for p in np.flatnonzero(small).tolist():
            window[-(top - width) % p :: p] = False
        found += (top - width + np.flatnonzero(window)[::-1]).tolist()
        top -= width
    return found[:count]


def hessenberg(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Matrices modulo primes (block, d, d), reduced to Hessenberg form by similarities, in place."""
    d, m = h.shape[1], p[:, None]
    for k in range(d - 2):
        for b in np.flatnonzero(h[:, k + 1, k] == 0):  # bring up a row that isn't 0 there, and its column
            rest = np.flatnonzero(h[b, k + 2 :, k])
            if len(rest):
                i = k + 2 + int(rest[0])
                h[b, [k + 1, i]] = h[b, [i, k + 1]]
                h[b][:, [k + 1, i]] = h[b][:, [i, k + 1]]
        inverse = np.array([pow(int(a), -1, int(q)) if a else 0 for a, q in zip(h[:, k + 1, k], p, strict=True)], np.int64)
        u = h[:, k + 2 :, k] * inverse[:, None] % m
        h[:, k + 2 :, :] = (h[:, k + 2 :, :] - u[:, :, None] * h[:, None, k + 1, :] % p[:, None, None]) % p[:, None, None]
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * u[:, None, :] % p[:, None, None]).sum(2)) % m
    return h


def polynomials(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Characteristic polynomials of Hessenberg matrices modulo primes; coefficients from the constant up."""
    blocks, d, _ = h.shape
    m = p[:, None]
    found = [np.zeros((blocks, d + 1), np.int64)]
    found[0][:, 0] = 1
    for k in range(d):
        now = np.roll(found[k], 1, 1)
        now = (now - h[:, k, k, None] * found[k]) % m
        below = np.ones(blocks, np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            now = (now - (h[:, i, k] * below % p)[:, None] * found[i]) % m
        found.append(now)
    return found[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Of a symmetric matrix of whole numbers without negative roots, exact; coefficients from the constant up.

    Maclaurin's inequality bounds the coefficients by the trace, and with them
    the primes that remaindering needs. Each task takes some of the primes.
    """
    d = len(matrix)
    trace = int(np.trace(matrix)) if d else 0
    bits = max(math.comb(d, k).bit_length() + max(0, math.ceil(k * (math.log2(trace / d) if trace else 0))) + 2 for k in range(d + 1))
    chosen = primes(max(2, -(-(bits + 2) // 30)))
    entries = [[int(v) for v in row] for row in matrix]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BLOCK):
                p = frame["p"].to_numpy(np.int64)[at : at + BLOCK]
                h = np.array([[[v % q for v in row] for row in entries] for q in p.tolist()], np.int64)
                yield pd.DataFrame({"p": p, "c": polynomials(hessenberg(h, p), p).tolist()})

    parts = max(1, len(chosen) // BLOCK)
    residues = {r["p"]: r["c"] for r in spark.createDataFrame([(p,) for p in chosen], "p long").repartition(parts).mapInPandas(run, "p long, c array<long>").collect()}
    whole = math.prod(chosen)
    weights = {p: whole // p * pow(whole // p, -1, p) for p in chosen}
    out = []
    for j in range(d + 1):
        c = sum(residues[p][j] * weights[p] for p in chosen) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


def roots_above(poly: list[int], m: int, s: int) -> int:
    """How many roots are greater than m / 2**s, each as often as it occurs, if all roots are real: the sign variations of the shifted polynomial."""
    while s > 0 and m % 2 == 0:
        m, s = m >> 1, s - 1
    d = len(poly) - 1
    c = [a << s * (d - j) for j, a in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += m * c[j + 1]
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _refined(poly: list[int], lo: int, hi: int, s: int) -> int:
    """The only root in (lo, hi] at scale 2**-s, to the last bit or next to it: Newton steps that bisection guards."""
    d = len(poly) - 1

    def at(x: int) -> tuple[int, int]:
        f = df = 0
        for j in range(d, -1, -1):
            df = df * x + (f << s)
            f = f * x + (poly[j] << s * (d - j))
        return f, df

    above = at(hi)[0]
    if above == 0:
        return hi
    x = (lo + hi) // 2
    while hi - lo > 1:
        f, df = at(x)
        if f == 0:
            return x
        if (f > 0) == (above > 0):
            hi = x
        else:
            lo = x
        step = x - (f << s) // df if df else lo
        if abs(step - x) <= 1:
            for y in (step - 2, step + 2):  # close in from both sides
                if lo < y < hi:
                    f = at(y)[0]
                    lo, hi = (lo, y) if f == 0 or (f > 0) == (above > 0) else (y, hi)
        x = step if lo < step < hi else (lo + hi) // 2
    return hi


def largest_roots(poly: list[int], count: int) -> tuple[list[tuple[int, int]], int]:
    """The ``count`` largest positive roots as (root at scale 2**-s, multiplicity), falling, and s. Fewer if there are fewer.

    Roots that differ by less than 2**-DIGITS of the largest count as one.
    """
    zeros = next(j for j, c in enumerate(poly) if c)
    poly = poly[zeros:]
    total = len(poly) - 1
    if not total:
        return [], 0
    bits = max(1, (-poly[-2]).bit_length()) + 1  # the sum of the roots
    s = max(0, DIGITS - bits)
    open_, found = [(0, 1 << bits + s, total, 0)], []
    finest = max(1, 1 << max(0, bits + s - DIGITS))
    while open_:
        lo, hi, over_lo, over_hi = open_.pop()
        if over_lo == over_hi or over_hi >= count:
            continue
        if over_lo - over_hi == 1:
            found.append((_refined(poly, lo, hi, s), 1))
        elif hi - lo <= finest:
            found.append((hi, over_lo - over_hi))
        else:
            mid = (lo + hi) // 2
            over = roots_above(poly, mid, s)
            open_ += [(lo, mid, over_lo, over), (mid, hi, over, over_hi)]
    return found, s


def null_space(matrix: list[list[int]], root: int, s: int, many: int) -> np.ndarray:
    """``many`` orthonormal vectors that the matrix minus root / 2**s takes to nothing, as doubles.

    Inverse iteration on a fixed-point factorisation with row pivots, twice from
    each start, then orthogonalised in whole numbers.
    """
    d, g = len(matrix), DIGITS + 64
    a = np.array([[v << g for v in row] for row in matrix], object).reshape(d, d)
    a[np.diag_indices(d)] -= root << g - s if g >= s else root >> s - g
    order, factors = np.arange(d), []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        for f in factors:
            f[[k, pivot]] = f[[pivot, k]]
        a[k, k] = a[k, k] or 1
        f = np.zeros(d, object)
        f[k + 1 :] = (a[k + 1 :, k] << g) // a[k, k]
        a[k + 1 :, k + 1 :] -= (f[k + 1 :, None] * a[None, k, k + 1 :]) >> g
        factors.append(f)
    kept: list[np.ndarray] = []
    for start in range(many):
        x = np.array([(1 + (31 * i * i + 17 * start * i + start) % 101) << g for i in range(d)], object)
        for _ in range(2):
            x = x[order]
            for k in range(d):
                x[k + 1 :] -= (factors[k][k + 1 :] * x[k]) >> g
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] << g) // a[k, k]
                x[:k] -= (a[:k, k] * x[k]) >> g
            for y in [*kept, *kept]:
                x = x - (y * ((x * y).sum() >> g) >> g)
            norm = math.isqrt(int((x * x).sum()))
            x = (x << g) // norm
        kept.append(x)
    out = np.array([[v / (1 << g) for v in x] for x in kept]).reshape(many, d)
    return out * np.where(out[np.arange(many), np.abs(out).argmax(1)] < 0, -1, 1)[:, None]


def principal_components(spark: SparkSession, scatter: np.ndarray, count: int) -> tuple[np.ndarray, list[Fraction]]:
    """Unit eigenvectors (rows) of the ``count`` largest positive eigenvalues of a whole-number scatter, and these. A task takes each."""
    roots, s = largest_roots(characteristic_polynomial(spark, scatter), count)
    if not roots:
        return np.zeros((0, len(scatter))), []
    matrix = [[int(v) for v in row] for row in scatter]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, root, many in frame.itertuples(index=False):
                yield pd.DataFrame({"at": at, "vector": null_space(matrix, int(root), s, many).tolist()})

    rows = spark.createDataFrame([(i, str(r), m) for i, (r, m) in enumerate(roots)], "at int, root string, many int").repartition(min(len(roots), 16))
    vectors: dict[int, list] = {}
    for r in rows.mapInPandas(run, "at int, vector array<double>").collect():
        vectors.setdefault(r["at"], []).append(r["vector"])
    found = [(v, Fraction(root, 1 << s)) for i, (root, _) in enumerate(roots) for v in sorted(vectors[i], reverse=True)][:count]
    return np.array([v for v, _ in found]), [e for _, e in found]


def _centred(y: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * y - sums, exact."""
    if n * max(1, _largest(y)) < 1 << 61 and all(abs(v) < 1 << 61 for v in sums):
        return n * y - sums.astype(np.int64)
    return n * y.astype(object) - sums


def whiten(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Whitened coordinates of every usable vector, a row for each of its components.

    Columns: the key, component int (from 1, by falling eigenvalue), n long,
    deviation long, whitened double, explained double, identity_error double.
    Unusable vectors (null, empty, or with a null or non-finite entry) give no
    rows. Repeated rows and null keys are kept and counted. Components without
    variance have no whitened value and are left out: equal vectors, a single
    one and an empty table give no rows. A deviation that no long holds is
    null. Vectors of different lengths are an error. Further columns are dropped.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums, products = moments(embeddings, column)
    scatter = n * products - np.outer(sums, sums) if n else products
    axes, values = principal_components(spark, scatter, components) if n else (np.zeros((0, 0)), [])
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    scale = np.array([math.isqrt(int(v * (1 << 256))) / (1 << 128) for v in values])  # n times the component's deviation
    trace = Fraction(int(np.trace(scatter)))
    explained = np.array([float(v / trace) for v in values])

    def whitened(rows: np.ndarray) -> np.ndarray:
        return _centred(rows, n, sums).astype(np.float64) @ axes.T / scale

    def totals(mean: np.ndarray | None):
        """A task's sums of whitened rows, or, given their mean, of products of what is left."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(k if mean is None else k * k)
            for batch in batches:
                _, rows = whole_numbers(batch.column(0))
                if len(rows):
                    w = whitened(rows)
                    held += w.sum(0) if mean is None else ((w - mean).T @ (w - mean)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held)), pa.int32()), pa.array(held)], names=["at", "v"])

        found = embeddings.select(column).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        return np.array([r["v"] for r in sorted(found, key=lambda r: r["at"])]) / n

    covariance = totals(totals(None)).reshape(k, k)
    error = float(np.abs(covariance - np.eye(k)).max())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = whole_numbers(batch.column(1))
            keys = batch.column(0).filter(pa.array(good))
            for at in range(0, len(rows), _ROWS):
                y = _centred(rows[at : at + _ROWS], n, sums)
                exact = y if _largest(y) ** 2 * y.shape[1] < 1 << 62 else y.astype(object)
                deviation = pa.array([v if v < 1 << 63 else None for v in (exact * exact).sum(1).tolist()], pa.int64())
                many = len(y)
                of = pa.array(np.repeat(np.arange(many), k))
                columns = [keys.slice(at, many).take(of), np.tile(np.arange(1, k + 1, dtype=np.int32), many), np.full(many * k, n, np.int64), deviation.take(of)]
                columns += [(y.astype(np.float64) @ axes.T / scale).ravel(), np.tile(explained, many), np.full(many * k, error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return embeddings.select(key, column).mapInArrow(emit, schema)
