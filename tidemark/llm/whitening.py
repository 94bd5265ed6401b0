"""Whitening of vectors from the exact characteristic polynomial of their scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import cut, kept, settled

#: Fixed value: entries are multiplied by this, then cut down to whole numbers.
GRID = 256
#: Bits of a limb of an entry, and rows whose products of limbs a double still adds up exactly.
_LIMB, _ROWS = 21, 2048
#: Bits of a word that sums travel in, and words of a sum.
_WORD, _WORDS = 32, 6
#: Relative precision of eigenvalues in bits, and decimal digits that components are computed in.
_BITS, _DIGITS = 120, 100
#: Primes for a task.
_PRIMES = 8


def on_grid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the entries as whole multiples of 1 / ``GRID``. Rows whose vector is
    NULL, empty, or holds NULL or non-finite entries are left out. Entries beyond 64 bits stop at
    the largest long."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = cut(vectors, vec_id=vec_id, vector=embedding).where(F.size("vector") > 0).where(~F.exists("vector", bad))
    return rows.select("vec_id", F.transform("vector", lambda c: F.floor(c.cast("double") * GRID)).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as the sum of limbs times powers of 2**_LIMB; all but the last lie in [0, 2**_LIMB)."""
    limbs = []
    while x.size and (x.max() >= 1 << _LIMB or x.min() < -(1 << _LIMB)):
        limbs.append((x & ((1 << _LIMB) - 1)).astype(np.float64))
        x = x >> _LIMB
    return [*limbs, x.astype(np.float64)]


def products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` in whole numbers of any size."""
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for start in range(0, x.shape[0], _ROWS):
        limbs = _limbs(x[start : start + _ROWS])
        for i, left in enumerate(limbs):
            for j, right in enumerate(limbs):
                total += (left.T @ right).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def scatter(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums, and ``n * sum(x x') - S S'``, which is the scatter of the centred
    rows times ``n``, all exact: whole numbers lose nothing by being centred after they are
    multiplied. A task sends ``(width + 1)**2 / 2`` sums, however many rows it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                total += products(np.column_stack([x, np.ones(x.shape[0], dtype=np.int64)]))
        left, right = np.triu_indices(width + 1)
        sums = [int(total[i, j]) for i, j in zip(left, right)]
        words = [[(abs(s) >> (_WORD * w) & ((1 << _WORD) - 1)) * (-1 if s < 0 else 1) for s in sums] for w in range(_WORDS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int32()), pa.array(right, pa.int32()), *(pa.array(w, pa.int64()) for w in words)], ["i", "j", *(f"w{w}" for w in range(_WORDS))])

    names = [f"w{w}" for w in range(_WORDS)]
    parts = fit.select("x").mapInArrow(run, "i int, j int, " + ", ".join(f"{name} long" for name in names))
    total = np.zeros((width + 1, width + 1), dtype=object)
    for row in parts.groupBy("i", "j").agg(*(F.sum(name).alias(name) for name in names)).collect():
        value = sum(row[name] << (_WORD * w) for w, name in enumerate(names))
        total[row["i"], row["j"]] = total[row["j"], row["i"]] = value
    n, sums = int(total[width, width]), total[width, :width]
    return n, [int(s) for s in sums], n * total[:width, :width] - np.outer(sums, sums)


def _prime(n: int) -> bool:
    """Miller-Rabin, whose bases 2, 3, 5 and 7 decide below 3.2e9."""
    if n % 2 == 0 or n < 9:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes() -> Iterator[int]:
    """Primes below 2**31, descending: products of two residues fit into 64 bits."""
    return (n for n in count((1 << 31) - 1, -2) if _prime(n))


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of the characteristic polynomial modulo ``p``, the constant first: similar
    transformations bring the matrix to Hessenberg form, whose leading minors follow from each
    other."""
    h = (matrix % p).astype(np.int64)
    d = h.shape[0]
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not below.size:
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1][None, :] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors[None, :] % p).sum(axis=1)) % p
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        step = np.zeros(d + 1, dtype=np.int64)
        step[1:] = minors[k - 1, :-1]
        chain, factors = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            factors[i] = chain * int(h[i, k - 1]) % p
            chain = chain * int(h[i, i - 1]) % p if i else chain
        minors[k] = (step - (factors[:, None] * minors[:k] % p).sum(axis=0)) % p
    return [int(c) for c in minors[d]]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The characteristic polynomial of a symmetric matrix of whole numbers without negative
    eigenvalues, the constant first.

    Its coefficients are bounded by what equal eigenvalues of the same trace would give, which
    says how many primes are needed. Tasks of a few primes each compute it modulo those; the
    residues, one row for each prime, make up the whole numbers by Chinese remaindering."""
    d, trace = matrix.shape[0], int(np.trace(matrix))
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    needed = (2 * bound).bit_length() // 30 + 1
    chosen = list(islice(primes(), needed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array([polynomial_modulo(matrix, p) for p in ps], pa.list_(pa.int64()))], ["p", "c"])

    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(max(1, math.ceil(needed / _PRIMES)), "p")
    rows = table.mapInArrow(run, "p long, c array<long>").collect()
    modulus = math.prod(row["p"] for row in rows)
    parts = [(modulus // row["p"]) * pow(modulus // row["p"], -1, row["p"]) for row in rows]
    whole = [sum(part * row["c"][k] for part, row in zip(parts, rows)) % modulus for k in range(d + 1)]
    return [c - modulus if 2 * c > modulus else c for c in whole]


def roots_above(polynomial: list[int], at: int) -> int:
    """How many roots lie above ``at``, each as often as it is one. All roots are real, so the
    changes of sign of the polynomial shifted by ``at`` count them exactly."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(polynomial: list[int], at: int) -> int:
    total = 0
    for c in reversed(polynomial):
        total = total * at + c
    return total


def root(polynomial: list[int], number: int, most: int) -> tuple[int, int] | None:
    """The root that is ``number``-th from above (from 1, each as often as it is one), as a
    whole number and the power of two that it is divided by; None unless it is above 0.
    ``most`` is no less than any root.

    Counts of roots isolate it; once it is alone in its interval, signs of the polynomial halve
    that until ``_BITS`` bits are settled. Roots that are equal, or equal in all these bits, are
    told apart by nothing but their number."""
    if roots_above(polynomial, 0) < number:
        return None
    low, high, power, alone = 0, most, 0, False
    above_low, above_high = roots_above(polynomial, 0), 0
    scaled = list(polynomial)
    while (high - low) << _BITS > high:
        if high - low == 1:
            low, high, power = low << 32, high << 32, power + 32
            scaled = [c << (power * (len(polynomial) - 1 - k)) for k, c in enumerate(polynomial)]
        middle = (low + high) // 2
        if alone:
            value = _value(scaled, middle)
            right = value == 0 or (value > 0) == (above_high % 2 == 0)  # the sign next above the root
            low, high = (low, middle) if right else (middle, high)
        else:
            above = roots_above(scaled, middle)
            if above >= number:
                low, above_low = middle, above
            else:
                high, above_high = middle, above
            alone = above_low - above_high == 1
    return high, power


def components(matrix: np.ndarray, values: list[tuple[int, int]]) -> np.ndarray:
    """Unit vectors of the null spaces of ``matrix - value``, as columns, by inverse iteration in
    ``_DIGITS`` digits. Each is kept orthogonal to those before it, so an eigenvalue that occurs
    twice has two of them. The largest entry of each is positive."""
    d, found = matrix.shape[0], []
    with localcontext() as context:
        context.prec = _DIGITS
        whole = np.array([[Decimal(int(v)) for v in row] for row in matrix], dtype=object)
        for number, (value, power) in enumerate(values):
            shift = Decimal(value) / Decimal(2) ** power
            tiny = max(shift, Decimal(1)) * Decimal(10) ** (10 - _DIGITS)
            a = whole.copy()
            a[np.arange(d), np.arange(d)] -= shift
            order = np.arange(d)
            for k in range(d):  # rows are exchanged so that the largest entry divides
                pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
                a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
                if abs(a[k, k]) < tiny:
                    a[k, k] = tiny
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
            vector = np.array([Decimal((7919 * (i + 1) * (number + 1)) % 1009 + 1) for i in range(d)], dtype=object)
            for _ in range(4):
                vector = _orthogonal(vector, found)[order]
                for k in range(d):
                    vector[k + 1 :] -= a[k + 1 :, k] * vector[k]
                for k in range(d - 1, -1, -1):
                    vector[k] = (vector[k] - (a[k, k + 1 :] * vector[k + 1 :]).sum()) / a[k, k]
                vector = _orthogonal(vector, found)
            found.append(vector)
    columns = np.array([[float(v) for v in vector] for vector in found]).reshape(len(found), d).T
    sign = np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(len(found))])
    return columns * sign


def _orthogonal(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``vector`` without its parts along the unit vectors ``others``, at length 1."""
    for _ in range(2):
        for other in others:
            vector = vector - other * (other * vector).sum()
        vector = vector / (vector * vector).sum().sqrt()
    return vector


@dataclass(frozen=True)
class Model:
    """What was fitted to ``n`` distinct vectors with the sums ``sums``."""

    n: int
    sums: tuple[int, ...]
    #: Eigenvalues of the covariance, falling, and their shares of its trace.
    variances: tuple[float, ...]
    explained: tuple[float, ...]
    #: Components as columns.
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: as longs where they fit, else as Python's whole numbers."""
        most = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))), default=0) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Squared lengths of :meth:`centred`; None where one is beyond a long."""
        y = self.centred(x)
        if y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) >= 1 << 63:
            squares = [sum(int(v) ** 2 for v in row) for row in y]
            return [s if s < 1 << 63 else None for s in squares]
        return (y * y).sum(axis=1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over the root of their variances."""
        y = self.centred(x).astype(np.float64) / self.n
        return (y @ self.vectors) / np.sqrt(np.array(self.variances))


def fit(distinct: DataFrame, width: int, most: int = 4) -> Model | None:
    """The model of rows ``x`` of ``width`` entries; None without rows. Components of variance
    zero cannot be whitened and are left out, so there may be fewer than ``most``, or none."""
    n, sums, matrix = scatter(distinct, width)
    if not n:
        return None
    trace = int(np.trace(matrix))
    polynomial = characteristic(distinct.sparkSession, matrix) if trace else [0] * width + [1]
    found = [root(polynomial, i + 1, trace) for i in range(min(most, width))] if trace else []
    values = [value for value in found if value is not None]
    return Model(n, tuple(sums), tuple(v / (n * n << p) for v, p in values), tuple(v / (trace << p) for v, p in values), components(matrix, values))


def _projected(rows: DataFrame, model: Model, width: int) -> DataFrame:
    """``vec_id, deviation`` and ``whitened``, an array with a number for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.deviations(x), pa.int64()), pa.array(model.whitened(x).tolist(), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>")


def _identity_error(distinct: DataFrame, model: Model, width: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity.
    Spark's ``covar_pop`` centres both sides before it multiplies."""
    k = len(model.variances)
    rows = _projected(distinct.withColumn("vec_id", F.lit(0)), model, width)
    at = lambda i: F.get("whitened", F.lit(i))
    entries: list[Column] = [F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    found = rows.agg(*entries).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))


def whiten(vectors: DataFrame, most: int = 4, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Vectors on a grid, projected on their first components and scaled to variance one:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each
    vector that takes part and each of up to ``most`` components.

    The model is fitted to each distinct vector on the grid once, so copies weigh nothing. All of
    it is exact in whole numbers up to the eigenvalues, which are known to ``_BITS`` bits, and the
    components, which are computed in ``_DIGITS`` digits; only then are there doubles.

    ``deviation`` is the sum of ``(n * x - S)**2``, NULL beyond a long. Rows that take no part
    (see :func:`on_grid`), or an empty table, give no rows; components of variance zero neither, so
    that one distinct vector alone gives none. Repeated rows and NULL ids are rows like others,
    equal eigenvalues get orthogonal components, further columns are left behind. Vectors of
    different lengths are an error.

    Copies are merged before the one shuffle, that of distinct vectors. What comes to the driver
    is the scatter and a row for each prime, whose number depends on the width of the vectors."""
    return settled(vectors.sparkSession, "whitened", lambda: _whiten(on_grid(vectors, vec_id, embedding), most))


def _whiten(rows: DataFrame, most: int) -> DataFrame:
    spark = rows.sparkSession
    least, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != width:
        raise ValueError(f"vectors have between {least} and {width} entries")
    distinct = kept(rows.select("x").distinct(), "distinct")
    model = fit(distinct, width, most) if width else None
    if model is None or not model.variances:
        empty = rows.where(F.lit(False)).select("vec_id")
        return empty.selectExpr("vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    error = _identity_error(distinct, model, width)
    return _projected(rows, model, width).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, model.explained)), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
