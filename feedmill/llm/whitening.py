"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

1. Vectors become whole numbers, floor(256 * entry). Spark finds the distinct ones
   and adds up their entries and products exactly: the scatter matrix
   M = n * sum(x x') - S S' has whole entries and is n squared times the covariance.
2. The characteristic polynomial of M is found modulo many primes, a part of them in
   each task, by reduction to Hessenberg form. Chinese remaindering gives its exact
   coefficients.
3. All roots are real, so the signs of the shifted polynomial's coefficients count the
   roots above any point exactly. Halving isolates the largest ones, to `ROOT_BITS` bits.
4. The null space of M - root * I, by inverse iteration in long decimals, gives the
   components. Roots that are equal to that precision share their null space, of which
   an orthonormal basis is taken.
5. A second pass projects every row.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import written

#: Entries are counted in steps of one part of this.
STEPS = 256
#: Bits of a root after the first one of the largest root.
ROOT_BITS = 100
#: Decimal digits of the inverse iteration.
DIGITS = 60
ROUNDS = 2
#: Primes that a task reduces at a time.
TOGETHER = 8
LIMIT = 2**63 - 1
#: Bits of the parts that large sums are added up in.
LIMB = 40
#: Whole numbers below this are exact as floats.
EXACT = 2**53


# --- vectors as bytes ---------------------------------------------------------


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 * value); what no long can hold becomes the nearest long."""
    scaled = np.floor(values.astype(np.float64) * STEPS)
    out = np.clip(scaled, -(2.0**63), 2.0**62).astype(np.int64)
    large = scaled >= 2.0**62
    if large.any():
        out[large] = [min(LIMIT, int(v)) for v in np.minimum(scaled[large], 2.0**63)]
    return out


def pack(x: np.ndarray) -> bytes:
    """The one way to write a vector: two, four or eight bytes an entry, whichever is the least that holds all."""
    for kind in (np.int16, np.int32):
        limits = np.iinfo(kind)
        if not len(x) or (x.min() >= limits.min and x.max() <= limits.max):
            return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()
    return bytes([8]) + x.tobytes()


def unpack(cells: list[bytes], d: int) -> np.ndarray:
    """Packed vectors as the rows of a matrix."""
    out = np.empty((len(cells), d), np.int64)
    widths = np.array([c[0] for c in cells], np.int64)
    for width, kind in ((2, np.int16), (4, np.int32), (8, np.int64)):
        which = np.flatnonzero(widths == width)
        if len(which):
            raw = b"".join([cells[i][1:] for i in which.tolist()])
            out[which] = np.frombuffer(raw, kind).reshape(len(which), d)
    return out


def _rounded(batches):
    """(id, d, x) of the vectors whose entries are all there and finite."""
    for batch in batches:
        column = batch["vector"]
        kept = column.is_valid()
        lists = column.filter(kept)
        ids = batch["id"].filter(kept)
        flat = lists.flatten().cast(pa.float64())
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        good = bad[edges[1:]] == bad[edges[:-1]]
        x = whole_numbers(np.where(np.isfinite(values), values, 0.0))
        cells = [pack(x[a:b]) for a, b in zip(edges[:-1][good].tolist(), edges[1:][good].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [ids.filter(pa.array(good)), pa.array(sizes[good], pa.int64()), pa.array(cells, pa.binary())], ["id", "d", "x"]
        )


# --- moments ------------------------------------------------------------------


def _product(x: np.ndarray) -> np.ndarray:
    """x' x of whole numbers, exactly."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if most * most * len(x) < EXACT:
        real = x.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    if most * most * len(x) < LIMIT:
        return (x.T @ x).astype(object)
    whole = x.astype(object)
    return whole.T @ whole


def _limbs(values: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(k, limb, part): value k is the sum of its parts, each times 2 ** (LIMB * limb)."""
    ks, limbs, parts = [], [], []
    for k, v in enumerate(values):
        limb = 0
        while not -(1 << LIMB) <= v < 1 << LIMB:
            ks.append(k), limbs.append(limb), parts.append(v & ((1 << LIMB) - 1))
            v, limb = v >> LIMB, limb + 1
        ks.append(k), limbs.append(limb), parts.append(v)
    return ks, limbs, parts


def _moments(d: int):
    """The count, the sums, and the products of the upper triangle, in limbs."""
    upper = np.triu_indices(d)

    def moments(batches):
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            x = unpack(batch["x"].to_pylist(), d)
            if len(x):
                n += len(x)
                sums = sums + (x.sum(axis=0) if np.abs(x).max(initial=0) < 2**40 else x.astype(object).sum(axis=0)).astype(object)
                products = products + _product(x)
        if n:
            columns = _limbs([n, *map(int, sums), *map(int, products[upper])])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "limb", "part"])

    return moments


def _scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and M of the vectors of the fit list: some d * d / 2 numbers reach the driver, however many rows."""
    parts = fit.select("x").mapInArrow(_moments(d), "k long, limb long, part long")
    value = [0] * (1 + d + d * (d + 1) // 2)
    for row in parts.groupBy("k", "limb").agg(F.sum("part").alias("part")).collect():
        value[row["k"]] += row["part"] << LIMB * row["limb"]
    n, sums = value[0], value[1 : d + 1]
    m = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(zip(*(x.tolist() for x in np.triu_indices(d)), strict=True)):
        m[i][j] = m[j][i] = n * value[1 + d + k] - sums[i] * sums[j]
    return n, sums, m


# --- the characteristic polynomial --------------------------------------------


def _is_prime(n: int) -> bool:
    """Certain for n below 3,215,031,751."""
    if n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if base % n and x not in (1, n - 1):
            for _ in range(s - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
    return True


def primes(bound: int) -> list[int]:
    """Primes below 2 ** 31, the largest first, whose product exceeds `bound`."""
    out, product, p = [], 1, 2**31 - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def _inverses(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x ** (p - 2) modulo p: the inverse, and 0 for 0."""
    out, e, x = np.ones_like(x), p - 2, x % p
    while e.any():
        out = np.where(e & 1, out * x % p, out)
        x, e = x * x % p, e >> 1
    return out


def hessenberg_polynomials(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The coefficients, constant first, of the characteristic polynomials of a[i] modulo p[i].

    Similar transformations clear what is below the subdiagonal, column by column;
    the polynomials of the leading blocks then follow from each other.
    """
    a, k = a.copy(), np.arange(len(p))
    d, q = a.shape[1], p[:, None]
    for m in range(1, d - 1):
        pivot = m + np.argmax(a[:, m:, m - 1] != 0, axis=1)
        a[k, m], a[k, pivot] = a[k, pivot], a[k, m].copy()
        a[k, :, m], a[k, :, pivot] = a[k, :, pivot], a[k, :, m].copy()
        u = a[:, m + 1 :, m - 1] * _inverses(a[:, m, m - 1], p)[:, None] % q
        a[:, m + 1 :] = (a[:, m + 1 :] - u[:, :, None] * a[:, m, None] % q[:, None]) % q[:, None]
        a[:, :, m] = (a[:, :, m] + (a[:, :, m + 1 :] * u[:, None] % q[:, None]).sum(axis=2)) % q
    blocks = [np.zeros((len(p), d + 1), np.int64)]
    blocks[0][:, 0] = 1
    for j in range(d):
        block = -(a[:, j, j, None] * blocks[j]) % q
        block[:, 1:] += blocks[j][:, :-1]
        below = np.ones(len(p), np.int64)
        for i in range(j - 1, -1, -1):
            below = below * a[:, i + 1, i] % p
            block -= (a[:, i, j] * below % p)[:, None] * blocks[i] % q
        blocks.append(block % q)
    return blocks[d]


def _residues(m: list[list[int]], moduli: list[int]):
    def residues(batches):
        for batch in batches:
            for part in batch["id"].to_pylist():
                own = moduli[part * TOGETHER : (part + 1) * TOGETHER]
                a = np.array([[[v % p for v in row] for row in m] for p in own], np.int64)
                found = hessenberg_polynomials(a, np.array(own, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], ["p", "residues"]
                )

    return residues


def characteristic_polynomial(spark, m: list[list[int]]) -> list[int]:
    """det(x I - M), constant first, for a positive semidefinite M of whole numbers."""
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    # The k-th coefficient is a sum of products of k of the roots, greatest where all are alike.
    bound = max(comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    moduli = primes(2 * bound + 1)
    n_parts = -(-len(moduli) // TOGETHER)
    rows = spark.range(0, n_parts, 1, n_parts).mapInArrow(_residues(m, moduli), "p long, residues array<long>").collect()
    product, coefficients = 1, [0] * (d + 1)
    for row in rows:  # one row per prime: their number follows from d and the entries, not from the rows
        p = row["p"]
        step = product * pow(product % p, -1, p) if p > 1 else 0
        coefficients = [c + (r - c) % p * step for c, r in zip(coefficients, row["residues"], strict=True)]
        product *= p
        coefficients = [c % product for c in coefficients]
    return [c - product if 2 * c > product else c for c in coefficients]


def roots_above(polynomial: list[int], point: int, bits: int) -> int:
    """Roots above point / 2 ** bits, with their multiplicities, if all roots are real."""
    d = len(polynomial) - 1
    c = [v << bits * (d - k) for k, v in enumerate(polynomial)]
    for i in range(d):  # Taylor shift
        for k in range(d - 1, i - 1, -1):
            c[k] += point * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(polynomial: list[int], trace: int, wanted: int) -> list[tuple[Decimal, int]]:
    """The largest positive roots, each once with its multiplicity, until `wanted` are counted."""
    out, counted = [], 0
    bits = max(0, ROOT_BITS - max(0, trace.bit_length() - 1))
    positive = roots_above(polynomial, 0, 0)
    wanted = min(wanted, positive)
    top = trace + 1
    coarse_top = top
    while counted < wanted:
        low, high = 0, coarse_top  # whole numbers first, then `bits` more
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(polynomial, middle, 0) > counted else (low, middle)
        coarse_top = high
        low, high = low << bits, high << bits
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(polynomial, middle, bits) > counted else (low, middle)
        many = roots_above(polynomial, low, bits) - counted
        with localcontext() as context:
            context.prec = DIGITS
            out.append((Decimal(2 * low + 1) / Decimal(2 << bits), many))
        counted += many
    return out


# --- components ---------------------------------------------------------------


def _solved(a: list[list[Decimal]], sides: list[list[Decimal]], tiny: Decimal) -> list[list[Decimal]]:
    """The solutions of a x = side for each side, by elimination; pivots that vanish count as `tiny`."""
    d = len(a)
    rows = [[*a[i], *[s[i] for s in sides]] for i in range(d)]
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        if abs(rows[k][k]) < tiny:
            rows[k][k] = tiny
        inverse, pivot = 1 / rows[k][k], rows[k]
        for i in range(k + 1, d):
            factor = rows[i][k] * inverse
            if factor:
                rows[i] = rows[i][: k + 1] + [x - factor * y for x, y in zip(rows[i][k + 1 :], pivot[k + 1 :], strict=True)]
    out = []
    for s in range(len(sides)):
        x = [Decimal(0)] * d
        for k in range(d - 1, -1, -1):
            rest = sum((rows[k][j] * x[j] for j in range(k + 1, d)), Decimal(0))
            x[k] = (rows[k][d + s] - rest) / rows[k][k]
        out.append(x)
    return out


def _orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
    out: list[list[Decimal]] = []
    for v in vectors:
        for _ in range(2):
            for u in out:
                along = sum((x * y for x, y in zip(u, v, strict=True)), Decimal(0))
                v = [y - along * x for x, y in zip(u, v, strict=True)]
        size = sum((x * x for x in v), Decimal(0)).sqrt()
        out.append([x / size for x in v])
    return out


def null_space(m: list[list[int]], root: Decimal, many: int) -> list[list[float]]:
    """Unit vectors of the root's space, the entry furthest from zero positive."""
    d = len(m)
    rng = np.random.default_rng(d)
    with localcontext() as context:
        context.prec = DIGITS
        a = [[Decimal(v) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(m)]
        tiny = max(root, Decimal(1)).scaleb(-DIGITS)
        vectors = _orthonormal([[Decimal(int(v)) for v in rng.integers(1, 10**6, d)] for _ in range(many)])
        for _ in range(ROUNDS):
            vectors = _orthonormal(_solved(a, vectors, tiny))
    out = []
    for v in vectors:
        sign = 1 if max(v, key=abs) > 0 else -1
        out.append([sign * float(x) for x in v])
    return out


class Whitening:
    """What the fit list gives: n, S, the components and their eigenvalues."""

    def __init__(self, n: int, sums: list[int], trace: int, parts: list[tuple[float, float, list[float]]]):
        self.n, self.sums = n, sums
        self.most = max((abs(s) for s in sums), default=0)
        self.values = np.array([v for v, _, _ in parts])
        self.explained = [e for _, e, _ in parts]
        vectors = np.array([v for _, _, v in parts]).reshape(len(parts), len(sums))
        self.matrix = (vectors / np.sqrt(self.values)[:, None]).T if len(parts) else vectors.T
        self.trace = trace

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        if self.n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + self.most < LIMIT:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(np.float64) @ self.matrix

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of the offsets; None where no long holds it."""
        off = self.offsets(x)
        most = int(max(off.max(initial=0), -off.min(initial=0)))
        if off.dtype != object and most * most * max(1, off.shape[1]) <= LIMIT:
            return (off * off).sum(axis=1).tolist()
        found = (int(sum(int(v) * int(v) for v in row)) for row in off)
        return [v if v <= LIMIT else None for v in found]


def fit(fit_list: DataFrame, d: int, wanted: int) -> Whitening:
    """The whitening of a list of distinct packed vectors of length d."""
    n, sums, m = _scatter(fit_list, d)
    trace = sum(m[i][i] for i in range(d))
    parts: list[tuple[float, float, list[float]]] = []
    if trace > 0:
        polynomial = characteristic_polynomial(fit_list.sparkSession, m)
        for root, many in largest_roots(polynomial, trace, wanted):
            with localcontext() as context:
                context.prec = DIGITS
                value, share = float(root / (n * n)), float(root / trace)
            parts += [(value, share, v) for v in null_space(m, root, many)]
    return Whitening(n, sums, trace, parts[:wanted])


# --- rows ---------------------------------------------------------------------


def _covariance(model: Whitening, d: int):
    """(k, value): sums of the whitened components, then of their products."""
    upper = np.triu_indices(len(model.values))

    def covariance(batches):
        total = np.zeros(len(model.values) + len(upper[0]))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(unpack(batch["x"].to_pylist(), d))
                total += np.concatenate([w.sum(axis=0), (w.T @ w)[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], ["k", "value"])

    return covariance


def identity_error(fit_list: DataFrame, model: Whitening, d: int) -> float:
    """The largest entry of the whitened covariance minus the identity."""
    k = len(model.values)
    summed = fit_list.select("x").mapInArrow(_covariance(model, d), "k long, value double").groupBy("k").agg(F.sum("value").alias("value"))
    value = {row["k"]: row["value"] / model.n for row in summed.collect()}  # some ten rows
    mean = np.array([value[i] for i in range(k)])
    found = np.zeros((k, k))
    found[np.triu_indices(k)] = [value[k + i] for i in range(k * (k + 1) // 2)]
    off = np.abs(found - np.outer(mean, mean) - np.eye(k))
    return float(np.triu(off).max(initial=0.0))


def _projected(model: Whitening, d: int, error: float):
    k = len(model.values)

    def projected(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = unpack(batch["x"].to_pylist(), d)
            times = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(model.deviations(x), pa.int64()).take(times)
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(times), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, model.n, np.int64)), deviation, pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(np.array(model.explained), len(x))), pa.array(np.full(size, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return projected


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null, infinite or undefined entries are left out,
    and so are those of another length than most (of lengths that are as frequent
    the greatest counts). The fit list has every distinct vector of whole numbers
    once; rows that repeat a vector or an id have rows of their own. Only components
    with an eigenvalue above zero are given, so a table whose vectors are all equal,
    empty or missing gives no rows. `deviation` is null where no long holds it.
    Entries beyond a long's range count as its nearest end. Other columns are not read.
    """
    kind = dict(vectors.dtypes)[id_col]
    out = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rounded = written(source.mapInArrow(_rounded, f"id {kind}, d long, x binary"), "rounded")
    usual = rounded.groupBy("d").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    if usual is None or usual["d"] == 0:
        return rounded.limit(0).mapInArrow(_projected(Whitening(0, [], 0, []), 0, 0.0), out).withColumnRenamed("id", id_col)
    d = usual["d"]
    rows = rounded.where(F.col("d") == d)
    fit_list = written(rows.select("x").distinct(), "fit")
    model = fit(fit_list, d, components)
    error = identity_error(fit_list, model, d) if len(model.values) else 0.0
    return rows.select("id", "x").mapInArrow(_projected(model, d, error), out).withColumnRenamed("id", id_col)
