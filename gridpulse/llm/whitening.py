"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Vectors become integers, so their scatter n * sum(x x^T) - S S^T is an integer matrix, summed exactly by the tasks. Its
characteristic polynomial is computed modulo many primes, each by Hessenberg reduction, spread over the tasks, and put
together by Chinese remaindering. All its roots are real, so sign changes of shifted coefficients isolate them, to
``ROOT_BITS`` bits; inverse iteration in ``DIGITS`` decimal digits gives the null vectors, one task for each root. What
reaches the driver is the square of the dimension, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.charpoly import coefficient_bits, combined, largest_roots, null_space, polynomial_mod, primes_below
from gridpulse.llm.common import shuffle_partitions, stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
BOUND = 1 << 52  # scaled components beyond it count as it
ROOT_BITS, DIGITS = 160, 70
LIMB, BATCH = 20, 4096  # products of two limbs, summed over a batch, stay below 2**53: exact in doubles
PART = 40  # exact sums travel as numbers of so many bits


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``sums`` are of x - ``offset``; ``weights`` are components over the root of their eigenvalue."""

    n: int
    dim: int
    offset: int
    sums: tuple[int, ...]
    weights: np.ndarray
    eigenvalues: tuple[float, ...]
    explained: tuple[float, ...]


def integer_vectors(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Rows (vec_id, x): floor(scale * entry) + offset. NULL vectors and those with NULL or non-finite entries are left out."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    bounded = lambda c: F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), c * F.lit(float(scale))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("c"))
    rows = rows.filter(F.col("c").isNotNull()).filter(F.forall("c", finite))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(bounded(c)).cast("long") + F.lit(offset)).alias("x"))


def _matrix(column: pa.Array, dim: int, offset: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim) - offset


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, each times 2**LIMB more than the one before, is ``x``."""
    out, half = [], 1 << (LIMB - 1)
    while len(x) and np.abs(x).max() >= half:
        low = ((x + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x - low) >> LIMB
    return [*out, x.astype(np.float64)]


def _moments(dim: int, offset: int):
    """Exact sums of x - offset (j = -1) and of its products (i <= j), for each task, as signed digits of PART bits."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                limbs = _limbs(_matrix(batch.column(0).slice(at, BATCH), dim, offset))
                for a, left in enumerate(limbs):
                    total += left.sum(axis=0).astype(np.int64).astype(object) << (LIMB * a)
                    for b, right in enumerate(limbs):
                        products += (left.T @ right).astype(np.int64).astype(object) << (LIMB * (a + b))
        i, j = np.triu_indices(dim)
        values = [*products[i, j], *total]
        digits = [[], [], [], [], []]
        for v in values:
            for d in digits[:-1]:
                d.append(int(v) & ((1 << PART) - 1))
                v = int(v) >> PART
            digits[-1].append(int(v))
        keys = [pa.array([*i, *range(dim)], pa.int32()), pa.array([*j, *[-1] * dim], pa.int32())]
        names = ["i", "j", *[f"d{k}" for k in range(len(digits))]]
        yield pa.RecordBatch.from_arrays([*keys, *[pa.array(d, pa.int64()) for d in digits]], names)

    return sums


def scatter(fit: DataFrame, n: int, dim: int, offset: int) -> tuple[list[int], list[list[int]]]:
    """Exact S and n * sum(x x^T) - S S^T of the rows of ``fit`` less ``offset``."""
    fields = ", ".join(f"d{k} long" for k in range(5))
    parts = fit.select("x").mapInArrow(_moments(dim, offset), f"i int, j int, {fields}")
    rows = parts.groupBy("i", "j").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(5)]).collect()  # dim * (dim + 3) / 2 rows
    exact = {(r["i"], r["j"]): sum(r[f"d{k}"] << (PART * k) for k in range(5)) for r in rows}
    s = [exact[i, -1] for i in range(dim)]
    return s, [[n * exact[min(i, j), max(i, j)] - s[i] * s[j] for j in range(dim)] for i in range(dim)]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x I - matrix), constant first, of a positive semidefinite integer matrix."""
    trace = sum(row[i] for i, row in enumerate(matrix))
    primes = primes_below(1 << 31, coefficient_bits(trace, len(matrix)) // 30 + 1)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(matrix, dtype=object)
        for batch in batches:
            found = [polynomial_mod((whole % p).astype(np.int64), p).tolist() for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "c"])

    listed = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), shuffle_partitions(spark)), "p")
    rows = listed.mapInArrow(reduce, "p long, c array<long>").collect()  # bounded by the dimension and the size of the entries
    return combined({r["p"]: list(r["c"]) for r in rows})


def eigenvectors(spark, matrix: list[list[int]], roots: list[tuple[int, int, int]]) -> np.ndarray:
    """Unit vectors for the ``roots`` in their order, each root's by a task of its own."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = null_space(matrix, roots[k], DIGITS).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([found], pa.list_(pa.list_(pa.float64())))], ["k", "v"])

    listed = spark.range(len(roots), numPartitions=len(roots))
    rows = sorted(listed.mapInArrow(solve, "k long, v array<array<double>>").collect())
    return np.array([v for r in rows for v in r["v"]])


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS, offset: int = OFFSET) -> Whitening:
    """The largest ``components`` principal directions of the rows of ``fit``, fewer where the rest have no variance."""
    spark, n = fit.sparkSession, fit.count()
    if not n or not dim:
        return Whitening(n, dim, offset, (0,) * dim, np.zeros((0, dim)), (), ())
    s, matrix = scatter(fit, n, dim, offset)
    trace, common = sum(matrix[i][i] for i in range(dim)), gcd(*[x for row in matrix for x in row])
    if not trace:
        return Whitening(n, dim, offset, tuple(s), np.zeros((0, dim)), (), ())
    reduced = [[x // common for x in row] for row in matrix]
    roots = largest_roots(characteristic_polynomial(spark, reduced), components, ROOT_BITS)
    vectors = eigenvectors(spark, reduced, roots)[:components]
    exact = [Fraction(a * common, 1 << b) for a, b, often in roots for _ in range(often)][:components]
    values = [float(e / (n * n)) for e in exact]
    weights = vectors / np.sqrt(np.array(values))[:, None]
    return Whitening(n, dim, offset, tuple(s), weights, tuple(values), tuple(float(e / trace) for e in exact))


def _centred(model: Whitening, x: np.ndarray) -> np.ndarray:
    """n * x - S, as 64-bit integers or, where they don't fit, Python's."""
    if len(x) and (int(np.abs(x).max()) + 1) * model.n + max(map(abs, model.sums)) >= 1 << 62:
        return model.n * x.astype(object) - np.array(model.sums, dtype=object)
    return model.n * x - np.array(model.sums, dtype=np.int64)


def _whitened(model: Whitening, centred: np.ndarray) -> np.ndarray:
    return (centred.astype(np.float64) / model.n) @ model.weights.T


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows of ``fit`` less the identity; 0 without components."""
    k = len(model.weights)
    if not k:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                w = _whitened(model, _centred(model, _matrix(batch.column(0).slice(at, BATCH), model.dim, model.offset)))
                total += w.T @ w
        a, b = np.indices((k, k)).reshape(2, -1)
        columns = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "s"])

    sums = fit.select("x").mapInArrow(products, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s"))
    error = F.abs(F.col("s") / model.n - F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0))
    return float(sums.agg(F.max(error)).first()[0])


def _project(model: Whitening):
    k = len(model.weights)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                centred = _centred(model, _matrix(part.column(1), model.dim, model.offset))
                largest = int(np.abs(centred).max()) if centred.size else 0
                exact = centred if largest * largest * model.dim < 1 << 63 else centred.astype(object)
                deviation = [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]
                times = np.repeat(np.arange(part.num_rows), k)
                columns = [
                    part.column(0).take(pa.array(times)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    pa.array(deviation, pa.int64()).take(pa.array(times)),
                    pa.array(_whitened(model, centred).ravel()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "deviation", "whitened"])

    return project


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Each distinct integer vector counts once in the fit, every row is projected. A vector's length has to be that of
    most distinct vectors (of equally frequent lengths the larger); others lack entries and take no part, as do vectors
    that are NULL or hold NULL or non-finite entries. Repeated rows and ids give rows each, a NULL vec_id stays NULL.
    Components have a variance above zero: with fewer of those there are fewer rows, and none for a single distinct
    vector, empty vectors or an empty table. Equal eigenvalues share a space, of which any orthonormal basis comes out,
    the same for all rows. Scaled entries beyond 2**52 count as 2**52; a deviation beyond 64 bits is NULL.
    """
    spark, rows = vectors.sparkSession, integer_vectors(vectors, scale, offset)
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    lengths = fit.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    fit = fit.filter(F.size("x") == dim)
    model = fit_whitening(fit, dim, components, offset)
    error = identity_error(fit, model)
    if not len(model.weights):
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    schema = "vec_id long, component int, deviation long, whitened double"
    out = rows.filter(F.size("x") == dim).mapInArrow(_project(model), schema)
    explained = F.get(F.array(*[F.lit(x) for x in model.explained]), F.col("component") - 1)
    return out.select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
