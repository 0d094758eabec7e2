"""Whitening of embeddings by principal components, from integer sums that are exact.

Entries become integers, so sums of products are exact whatever the order of
rows and however they are dealt to tasks: each task adds up its rows' products
(exact matrix products in limbs of 20 bits) and hands on d (d + 1) / 2 totals
as pieces of 32 bits, which Spark adds. The scatter is centred exactly, as
n sum(y y') - sum(y) sum(y)'; its characteristic polynomial gives eigenvalues,
and inverse iteration the components (``charpoly``). A second pass projects
every row. Only the sums and the polynomial (some d^2 numbers, none a row)
meet the driver; nothing is sampled.

Defined cases: a row is left out if its vector is null, empty, holds null, NaN
or infinite entries or ones of 2^52 and more (no long holds those), or has not
the number of entries that most of the other rows have (of equally frequent
ones the larger). Repeated rows and ids count as often as they stand; null ids
are kept. Components whose eigenvalue is zero can't be scaled and give no rows,
so without two different vectors the result is empty, as for an empty table.
Equal eigenvalues get components at right angles. ``deviation`` is null where
no long holds it; ``deviation_exact`` has it in 38 digits. Columns other than
the two that are named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import charpoly
from .common import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Bits of a limb, and rows whose products of limbs add up to less than 2^53.
LIMB, AT_ONCE = 20, 1 << 12


def _integers(column: pa.ListArray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be used, and floor(1024 c) of their entries."""
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    keep = np.flatnonzero(lengths == d)
    flat = column.take(pa.array(keep)).flatten()
    flat = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(keep), d)  # null is NaN
    with np.errstate(invalid="ignore"):
        good = (np.abs(flat) < 2.0**52).all(1)
    return keep[good], np.floor(flat[good] * SCALE).astype(np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact sums of products of an integer matrix's columns, as Python integers."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for at in range(0, len(y), AT_ONCE):
        rest, limbs = y[at : at + AT_ONCE], []
        while True:
            if len(rest) and np.abs(rest).max() < 1 << LIMB:
                limbs.append(rest.astype(np.float64))
                break
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j)
    return total


def _pieces(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    """A number as signed sum of pieces of 32 bits."""
    k = 0
    while not -(1 << 31) <= value < 1 << 31:
        yield i, j, k, value & 0xFFFFFFFF
        value, k = value >> 32, k + 1
    yield i, j, k, value


def _summer(d: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            _, y = _integers(batch.column(0), d)
            if len(y):
                n += len(y)
                total += (y >> 31).sum(0).astype(object) * (1 << 31) + (y & 0x7FFFFFFF).sum(0).astype(object)
                products += gram(y)
        rows = [*_pieces(-1, -1, n)] + [r for j in range(d) for r in _pieces(-1, j, int(total[j]))] + [r for i in range(d) for j in range(i, d) for r in _pieces(i, j, int(products[i, j]))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["i", "j", "k", "v"])  # noqa: B905

    return sums


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows n, sums y per dimension and n sum(y y') - sum(y) sum(y)' of the usable rows of (v), all exact."""
    rows = vectors.select("v").mapInArrow(_summer(d), "i long, j long, k long, v long").groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect()
    found: dict[tuple[int, int], int] = {}
    for r in rows:
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (r.v << 32 * r.k)
    n, total = found.get((-1, -1), 0), [found.get((-1, j), 0) for j in range(d)]
    return n, total, [[n * found.get((min(i, j), max(i, j)), 0) - total[i] * total[j] for j in range(d)] for i in range(d)]


def _projector(d: int, n: int, total: list[int], axes: np.ndarray, scales: list[float]):
    """Rows of (id, v) to (id, deviation, deviation_exact, w): w are the centred entries on the axes, divided by the scales."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, y = _integers(batch.column(1), d)
            most = n * int(np.abs(y).max(initial=0)) + max(map(abs, total))
            if d * most * most < 1 << 63:
                u = y * n - np.array(total, np.int64)
                exact = pa.array((u * u).sum(1))
            else:
                u = y.astype(object) * n - np.array(total, object)
                exact = pa.array([x if x < 10**38 else None for x in (u * u).sum(1)], pa.decimal128(38, 0))
            small = exact if pa.types.is_int64(exact.type) else pa.array([None if x is None or x >= 1 << 63 else int(x) for x in exact.to_pylist()], pa.int64())
            w = (u / n).astype(np.float64) @ axes.T / np.array(scales)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * len(scales), pa.int32()), pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), small, exact.cast(pa.decimal128(38, 0)), flat], names=["vec_id", "deviation", "deviation_exact", "w"])

    return project


def identity_error(rows: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of w (k numbers a row, whose means are zero but for rounding) minus the identity."""
    at = lambda i: F.get("w", F.lit(i))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.sum(at(i)) for i in range(k)], *[F.sum(at(i) * at(j)) for i, j in pairs]).first()
    return max(abs(v / n - found[i] / n * found[j] / n - (i == j)) for (i, j), v in zip(pairs, found[k:]))  # noqa: B905


def whitened(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact."""
    spark = df.sparkSession
    vectors = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    usable = F.forall("v", lambda x: F.coalesce(F.abs(x) < 2.0**52, F.lit(False)))  # NaN is larger than any number
    sizes = vectors.where((F.size("v") > 0) & usable).groupBy(F.size("v").alias("d")).count()
    common = sizes.agg(F.max_by("d", F.struct("count", "d"))).first()[0]
    n, total, matrix = scatter(vectors, common) if common else (0, [], [])
    roots = charpoly.largest_roots(charpoly.characteristic(spark, matrix), components) if n else []
    empty = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if not roots:
        return spark.createDataFrame([], empty)
    axes = charpoly.components(matrix, roots)
    trace = sum(matrix[i][i] for i in range(common))
    scales, shares = [sqrt(r / n**2) for r in roots], [float(r / trace) for r in roots]
    project = _projector(common, n, total, axes, scales)
    rows = written(vectors.mapInArrow(project, f"vec_id {id_type}, deviation long, deviation_exact decimal(38,0), w array<double>"), "whitened")
    error = identity_error(rows, n, len(roots))
    rows = rows.select("*", F.posexplode("w").alias("_pos", "whitened"))
    return rows.select(
        "vec_id", (F.col("_pos") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, shares)), F.col("_pos")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact",
    )
