"""Whitening of embeddings by polarisation covariance.

A vector's entries become whole numbers ``x = floor(256 c)``. Over the fit list, each distinct ``x`` once, tasks add up
exact squares only: ``y_i^2`` for every dimension and ``(y_i + y_j)^2`` for every pair of dimensions, with ``y`` the
entries less a whole number next to their mean. From these follow, in whole numbers, the exact squared deviations
``sum((n x_i - S_i)^2)`` and ``sum((n x_i + n x_j - S_i - S_j)^2)``, that is the variances of all dimensions and of all
sums of two. Differences of variances give the covariances, ``2 cov(i, j) = var(i + j) - var(i) - var(j)``; they are rounded
only when the matrix is put together for ``eigh``.

What moves: the distinct vectors are shuffled once, hot ones combined before; a task adds d (d + 1) / 2 sums, combined by
pair; the driver gets those sums once (at most ``MAX_DIMS`` dimensions), and tasks get four components back. Squares that
do not fit 64 bits are added as unbounded integers.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, as are vectors of another
length than the most frequent one (the longer on a tie), which lack entries. An entry beyond the range of a long takes the
end of the range. Repeated rows and rows without key keep a row each. A component whose eigenvalue is not above rounding
(fewer distinct vectors than dimensions, constant dimensions) can't be whitened and is left out, so a table of one
distinct vector gives no rows. A deviation that does not fit a long is null. Of equal eigenvalues any basis is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import ship
from lexigrid.plans.session import materialize

SCALE, COMPONENTS, MAX_DIMS = 256, 4, 4096
#: Rows that a task looks at together.
STEP = 4096
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: exact sums, the covariance matrix, components as rows and their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of ``x``; the difference from the mean is formed in whole numbers."""
        return (centred(x, self.n, self.sums).astype(float) / self.n) @ self.components.T / np.sqrt(self.values)


def whole(vector: Column) -> Column:
    """The entries as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, x)`` of the rows whose vectors can be used."""
    v = F.col(f"`{vector}`")
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    kept = df.select(F.col(f"`{key}`").alias("key"), v.alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)
    )
    rows = materialize(kept.select("key", whole(F.col("v")).alias("x")), "vectors")
    common = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "d"))["d"].alias("d"))
    d = common.first().d
    return rows.filter(F.size("x") == d) if d is not None else rows


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of longs."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return np.asarray(flat.flatten()).reshape(n, -1).astype(np.int64, copy=False) if n else np.zeros((0, 0), np.int64)


def largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n x - S``, exact."""
    if largest(x) * n + max(map(abs, sums), default=0) > LONG_MAX:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def add_up(x: np.ndarray) -> list[int]:
    """Exact sums over rows."""
    if largest(x) * max(1, len(x)) > LONG_MAX:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b in batches:
        x = matrix(b.column("x"))
        if len(x):
            n, part = n + len(x), add_up(x)
            total = part if total is None else [a + p for a, p in zip(total, part, strict=True)]
    if total is not None:
        yield pa.RecordBatch.from_pydict(
            {"i": list(range(-1, len(total))), "s": pa.array([n, *total], pa.decimal128(38, 0))}, schema=SUM_ARROW
        )


SUM_ARROW = pa.schema([("i", pa.int32()), ("s", pa.decimal128(38, 0))])
SQUARE_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])


def squares_of(shift: list[int]):
    """A task's sums of ``y_i^2`` (as i = j) and ``(y_i + y_j)^2``, with ``y = x - shift``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(shift)
        total = [[0] * (d - i) for i in range(d)]
        seen = False
        for b in batches:
            rows = matrix(b.column("x"))
            for at in range(0, len(rows), STEP):
                seen, x = True, rows[at : at + STEP]
                wide = 2 * (largest(x) + max(map(abs, shift)))
                exact = wide * wide * STEP > LONG_MAX or max(map(abs, shift)) > LONG_MAX
                y = x.astype(object) - np.array(shift, dtype=object) if exact else x - np.array(shift, dtype=np.int64)
                y = np.ascontiguousarray(y.T)
                for i in range(d):
                    pairs = y[i:] + y[i]
                    pairs[0] = y[i]
                    part = (pairs * pairs).sum(axis=1) if exact else np.einsum("ij,ij->i", pairs, pairs)
                    total[i] = [a + int(p) for a, p in zip(total[i], part, strict=True)]
        if seen:
            for i in range(d):
                yield pa.RecordBatch.from_pydict(
                    {"i": [i] * (d - i), "j": list(range(i, d)), "s": pa.array(total[i], pa.decimal128(38, 0))}, schema=SQUARE_ARROW
                )

    return run


def assemble(n: int, sums: list[int], shift: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from sums of squares, by polarisation in whole numbers."""
    d = len(sums)
    rest = [s - n * a for s, a in zip(sums, shift, strict=True)]

    def deviation(i: int, j: int) -> int:
        """n times the sum of squared deviations of a dimension or of a sum of two, times n for whole numbers."""
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i, j] - r * r

    own = [deviation(i, i) for i in range(d)]
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (deviation(i, j) - own[i] - own[j]) / (2 * n * n)
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Exact moments of the distinct vectors ``(x)`` and their leading components; None for an empty list."""
    ship(distinct.sparkSession)
    added = distinct.select("x").mapInArrow(_sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    got = {r.i: int(r.s) for r in added.limit(MAX_DIMS + 2).collect()}
    if not got:
        return None
    n, d = got[-1], len(got) - 1
    if d > MAX_DIMS:
        raise ValueError(f"vectors of more than {MAX_DIMS} dimensions")
    sums = [got[i] for i in range(d)]
    shift = [s // n for s in sums]
    parts = distinct.select("x").mapInArrow(squares_of(shift), "i int, j int, s decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # d (d + 1) / 2 rows
    covariance = assemble(n, sums, shift, {(r.i, r.j): int(r.s) for r in rows})
    values, vectors = np.linalg.eigh(covariance)
    trace = float(np.trace(covariance))
    order = [k for k in range(d - 1, -1, -1) if values[k] > trace * d * np.finfo(float).eps][:components]
    return Whitening(n, tuple(sums), covariance, np.ascontiguousarray(vectors[:, order].T), values[order], trace)


def whitened_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance less the identity, from a pass over the list.

    Covariances come from variances of coordinates and of sums of two, as in the fit.
    """
    k = len(model.values)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(pairs)))
        for b in batches:
            z = model.project(matrix(b.column("x"))) if b.num_rows else np.zeros((0, k))
            for m, (i, j) in enumerate(pairs):
                s = z[:, i] if i == j else z[:, i] + z[:, j]
                total[:, m] += s.sum(), (s * s).sum()
        yield pa.RecordBatch.from_pydict({"m": pa.array(range(len(pairs)), pa.int32()), "s": total[0], "q": total[1]})

    got = distinct.select("x").mapInArrow(run, "m int, s double, q double").groupBy("m").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    var = {pairs[r.m]: r.q / model.n - (r.s / model.n) ** 2 for r in got.collect()}
    off = lambda i, j: var[i, i] - 1 if i == j else (var[i, j] - var[i, i] - var[j, j]) / 2
    return max(abs(off(i, j)) for i, j in pairs)


WHITENED = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``WHITENED`` for every usable row and component; the fit covers all distinct vectors."""
    spark = df.sparkSession
    ship(spark)
    rows = usable(df.withColumn(key, F.col(f"`{key}`").cast("long")), key, vector)
    distinct = materialize(rows.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], WHITENED)
    error = whitened_error(distinct, model)
    share = [float(v / model.trace) for v in model.values]
    k = len(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            far = centred(x, model.n, model.sums)
            if far.dtype != object and largest(far) ** 2 * far.shape[1] > LONG_MAX:
                far = far.astype(object)
            dev = [v if v <= LONG_MAX else None for v in map(int, (far * far).sum(axis=1))]
            rows, z = np.repeat(np.arange(b.num_rows), k), model.project(x)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("key").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), b.num_rows), pa.int32()),
                    pa.array(np.full(len(rows), model.n), pa.int64()), pa.array(dev, pa.int64()).take(pa.array(rows)),
                    pa.array(z.ravel()), pa.array(np.tile(share, b.num_rows)), pa.array(np.full(len(rows), error)),
                ],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, WHITENED)
