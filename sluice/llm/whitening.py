"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Components are quantised to whole numbers x = floor(256 * c). The fit list holds each distinct x
once: n vectors with sums S. Its scatter n * sum(x x') - S S' (n * n times the covariance) is
summed exactly: tasks add blocks, whose products stay below 2**53, into Python integers, and
pass on 31-bit limbs, which a plain aggregate adds. The polynomial is computed modulo primes, one
prime per unit of work, and put together by Chinese remaindering; the largest roots are isolated
and refined to 160 bits; inverse iteration in decimal arithmetic gives the unit eigenvectors to double
precision, the entry of largest absolute value positive. Every row is then projected by a narrow pass.

Rows whose vector is NULL or holds NULL or non-finite components are dropped. Shorter vectors
count as padded with zeros. Quantised components saturate at the range of a long. A component
whose eigenvalue is exactly 0 is left out, so one distinct vector, or an empty table, gives no
rows. Equal eigenvalues give some orthonormal basis. Repeated rows are rows of their own and
enter the fit once. A deviation that does not fit a long is NULL. A NULL id is passed on; other columns are
never read. To the driver go d * (d + 1) / 2 sums and d + 1 residues per prime, whatever the rows.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, table
from sluice.llm.polynomial import BITS, largest_roots, null_vectors, polynomial_modulo, primes_for, remaindered
from sluice.llm.vectors import usable, widest

COMPONENTS = 4
SCALE = 256
LIMB = 31
# Place of the sums and of the count among the entries of the scatter.
SUMS = COUNT = -1


def quantised(vector: Column, dims: int) -> Column:
    """floor(256 * c) of every component as long, padded to ``dims``."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))


def whole_matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def limbs(value: int) -> list[int]:
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest:
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out


def added_products(x: np.ndarray) -> np.ndarray:
    """x' x in Python integers."""
    most = max(int(x.max()), -int(x.min()), 1)
    if most >= 1 << 26:
        wide = x.astype(object)
        return wide.T @ wide
    out, step = 0, (1 << 53) // (most * most)
    for low in range(0, len(x), step):
        part = x[low : low + step].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, n * sum(x x') - S S') of the vectors in column ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                x = whole_matrix(batch.column("x"), dims)
                n += len(x)
                sums = sums + x.astype(object).sum(axis=0)
                squares = squares + added_products(x)
        entries = [(SUMS, COUNT, n), *((SUMS, j, sums[j]) for j in range(dims))]
        entries += [(i, j, squares[i, j]) for i in range(dims) for j in range(i, dims)]
        rows = [(i, j, k, v) for i, j, value in entries for k, v in enumerate(limbs(int(value)))]
        i, j, k, v = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array(v, pa.int64())], names=["i", "j", "limb", "value"]
        )

    parts = fit.mapInArrow(run, "i int, j int, limb int, value long")
    total: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():
        total[r.i, r.j] = total.get((r.i, r.j), 0) + (r.value << (LIMB * r.limb))
    n, s = total.get((SUMS, COUNT), 0), [total.get((SUMS, j), 0) for j in range(dims)]
    full = [[n * total.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(dims)] for i in range(dims)]
    return n, s, full


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients (constant first) of a positive semi-definite integer matrix, primes spread over tasks.

    Absolute coefficients add up to det(1 + matrix), at most (1 + trace / d) ** d.
    """
    d = len(matrix)
    bound = 2 * (sum(matrix[i][i] for i in range(d)) // d + 2) ** d
    primes = primes_for(bound)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(shared.value, object)
        for batch in batches:
            found = batch.column("prime").to_pylist()
            polys = [polynomial_modulo((whole % p).astype(np.int64), p) for p in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(polys, pa.list_(pa.int64()))], names=["prime", "poly"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    residues = {r.prime: r.poly for r in dealt.mapInArrow(run, "prime long, poly array<long>").collect()}
    shared.unpersist()
    # The last prime is a check of all others.
    check = residues.pop(primes[-1])
    poly = remaindered(residues)
    if [c % primes[-1] for c in poly] != check:
        raise ArithmeticError("the residues of the characteristic polynomial disagree")
    return poly


@dataclass
class Whitening:
    """n and S of the fit list, and per component its unit vector over the root of the scatter."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]


def fitted(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors in column ``x``."""
    n, sums, full = scatter(fit, dims)
    trace = sum(full[i][i] for i in range(dims))
    weights, explained = [], []
    if trace:
        poly = characteristic_polynomial(fit.sparkSession, full)
        rank = dims - next(i for i, c in enumerate(poly) if c)
        wanted = min(components, rank)
        digits = 2 * len(str(trace)) + BITS * 2 // 3 + 40
        for numerator, shift, times in largest_roots(poly, trace, wanted):
            with decimal.localcontext() as context:
                context.prec = digits
                root = Decimal(numerator) / (1 << shift)
                for v in null_vectors(full, root, min(times, wanted - len(weights)), digits):
                    norm = root.sqrt().copy_sign(max(v, key=abs))
                    weights.append([float(x / norm) for x in v])
                    explained.append(float(root / trace))
    return Whitening(n, sums, np.array(weights).reshape(len(weights), dims), explained)


def projected(x: np.ndarray, model: Whitening) -> tuple[list[int | None], np.ndarray]:
    """Exact deviations, and the whitened components of whole vectors."""
    most = model.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, model.sums), default=0)
    if len(model.sums) * most * most < 1 << 63:
        y = model.n * x - np.array(model.sums, np.int64)
        deviation = (y * y).sum(axis=1).tolist()
    else:
        y = model.n * x.astype(object) - np.array(model.sums, object)
        deviation = [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]
    y = y.astype(np.float64)
    return deviation, np.stack([(y * w).sum(axis=1) for w in model.weights], axis=1)


def identity_error(fit: DataFrame, model: Whitening, dims: int, folder: WorkFolder) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white = projected(whole_matrix(batch.column("x"), dims), model)[1] if batch.num_rows else np.zeros((0, k))
            yield pa.RecordBatch.from_arrays([pa.array(white[:, c]) for c in range(k)], names=[f"w{c}" for c in range(k)])

    white = folder.write(fit.mapInArrow(run, ", ".join(f"w{c} double" for c in range(k))), "white")
    means = white.agg(*[F.avg(f"w{c}") for c in range(k)]).first()
    centred = [F.col(f"w{c}") - means[c] for c in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariance = white.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(covariance[m] - (i == j)) for m, (i, j) in enumerate(pairs))


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    folder = WorkFolder(spark, "whitening")
    valid = vectors.filter(usable(F.col(vector_col)))
    dims = widest(valid, vector_col)
    rows = valid.select(F.col(id_col).alias("id"), quantised(F.col(vector_col), dims).alias("x"))
    fit = folder.write(rows.select("x").distinct(), "fit")
    model = fitted(fit, dims, components)
    k = len(model.weights)
    error = identity_error(fit, model, dims, folder) if k else 0.0
    folder.drop("fit", "white")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not (k and batch.num_rows):
                continue
            deviation, white = projected(whole_matrix(batch.column("x"), dims), model)
            rows = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(rows), model.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(rows)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(model.explained, batch.num_rows)),
                    pa.array(np.full(len(rows), error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    out = rows.mapInArrow(run, f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
