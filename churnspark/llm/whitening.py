"""Whitening of embeddings by their leading principal components (operator 13).

Entries become integers, so that counts, sums and deviations are exact. Every partition keeps the
spectrum of its rows up to date by centred rank-one updates (``spectrum``), spectra are combined in
a tree of ``FAN_IN`` at a time by further rank-one updates, and the basis found so is refined by one
Rayleigh-Ritz step: rows are projected on it, the covariance of the projections is summed over
all partitions, and its eigenvectors turn the basis. What a task holds and what reaches the driver
are matrices of the dimension's size, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.spectrum import Spectrum
from churnspark.runtime import materialize

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
FAN_IN = 8
ROWS_AT_ONCE = 4096
# Integers beyond this size could not be counted on in a double.
_FARTHEST = float(1 << 52)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(column: pa.Array, size: int) -> np.ndarray:
    """Rows of floor(1024 * entry) + 100000 of a column of lists that all have ``size`` entries."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.clip(np.floor(SCALE * flat), -_FARTHEST, _FARTHEST)
    return (scaled.astype(np.int64) + SHIFT).reshape(-1, size)


def _rows(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(first, ROWS_AT_ONCE)
            yield part, integers(part.column(at), size)


def _spectra(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = Spectrum(size), np.zeros(size, np.int64)
        for _, rows in _rows(batches, 0, size):
            sums += rows.sum(axis=0)
            for row in rows.astype(np.float64):
                found.add(row)
        if found.n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([found.n], pa.int64()),
                    pa.array([sums.tolist()], pa.list_(pa.int64())), pa.array([found.to_bytes()], pa.binary()),
                ],
                names=["part", "n", "sums", "spectrum"],
            )

    return run


def _merged(size: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        held = table.column("spectrum").to_pylist()
        total = Spectrum.from_bytes(held[order[0]], size)
        for i in order[1:]:
            total.merge(Spectrum.from_bytes(held[i], size))
        group = int(table.column("part")[0].as_py()) // FAN_IN
        return pa.table({"part": pa.array([group], pa.int64()), "spectrum": pa.array([total.to_bytes()], pa.binary())})

    return run


def combined(spectra: DataFrame, size: int, parts: int) -> Spectrum:
    """One spectrum of all rows of (part, spectrum), whose parts are numbered below ``parts``."""
    level = spectra.select("part", "spectrum")
    while parts > 1:
        grouped = level.groupBy(F.floor(F.col("part") / FAN_IN))
        level = grouped.applyInArrow(_merged(size), "part bigint, spectrum binary")
        parts = -(-parts // FAN_IN)
    return Spectrum.from_bytes(bytes(level.first()["spectrum"]), size)


def _projected(size: int, mean: np.ndarray, basis: np.ndarray):
    """Rows (i, sums): what a partition adds to row i of the scatter of the projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for _, rows in _rows(batches, 0, size):
            found = (rows - mean) @ basis
            total += found.T @ found
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "sums"]
        )

    return run


def scatter(vectors: DataFrame, size: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum of outer products of the centred rows, projected on the columns of ``basis``."""
    rows = vectors.mapInArrow(_projected(size, mean, basis), "i bigint, sums array<double>")
    summed = rows.select("i", F.posexplode("sums").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s"))
    found = np.zeros((basis.shape[1], basis.shape[1]))
    for r in summed.collect():  # one number per pair of columns
        found[r["i"], r["j"]] = r["s"]
    return (found + found.T) / 2


@dataclass
class Whitening:
    """What whitening needs: exact count and sums, leading eigenvalues and unit eigenvectors, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    merged: Spectrum | None = None

    @property
    def size(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        # Whole part first: a sum may have more digits than a double.
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def scaled(self) -> np.ndarray:
        """The projection that whitens; a component without variance projects to 0."""
        known = self.values > 0
        return self.vectors * np.where(known, 1 / np.sqrt(np.where(known, self.values, 1.0)), 0.0)


def usable_vectors(vectors: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Rows whose vector has numbers only, and the dimension: the commonest length, of equals the longest."""
    valid = vectors.where(_usable(F.col(vector_col)))
    sizes = valid.groupBy(F.size(vector_col).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return valid.where(F.size(vector_col) == size), size


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all rows of ``vectors``, a table of one column of lists of ``size`` numbers."""
    stored = materialize(vectors.mapInArrow(_spectra(size), "part bigint, n bigint, sums array<bigint>, spectrum binary"), "spectra")
    spread = stored.agg(F.sum("n").alias("n"), F.max("part").alias("part")).first()
    if not spread["n"] or size == 0:
        return Whitening(0, [0] * size, np.zeros(0), np.zeros((size, 0)), 0.0)
    by_place = stored.select(F.posexplode("sums").alias("j", "s")).groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [0] * size
    for r in by_place.collect():  # one number per dimension
        sums[r["j"]] = int(r["s"])
    whitening = Whitening(spread["n"], sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    merged = combined(stored, size, spread["part"] + 1)
    # Rayleigh-Ritz: the merged directions, made orthonormal to the last digit, and what the rows say about them.
    basis, _ = np.linalg.qr(merged.vectors[:, ::-1])
    values, turned = np.linalg.eigh(scatter(vectors, size, whitening.mean, basis) / whitening.n)
    order = np.argsort(-values, kind="stable")
    trace = float(np.maximum(values, 0).sum())
    chosen = order[: min(components, size)]
    found = basis @ turned[:, chosen]
    found *= np.where(found[np.abs(found).argmax(axis=0), np.arange(len(chosen))] < 0, -1.0, 1.0)
    kept = values[chosen]
    whitening.values = np.where(kept > 1e-12 * trace, kept, 0.0)
    whitening.vectors, whitening.trace, whitening.merged = found, trace, merged
    return whitening


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity, over components with variance."""
    used = np.flatnonzero(whitening.values > 0)
    if whitening.n == 0 or len(used) == 0:
        return 0.0
    basis = whitening.scaled()[:, used]
    found = scatter(vectors, whitening.size, whitening.mean, basis) / whitening.n
    return float(np.abs(found - np.eye(len(used))).max())


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n * x - S)^2; null beyond a long."""
    most = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
    bound = n * most + max(map(abs, sums), default=0)
    if bound * bound * max(len(sums), 1) < 1 << 63:
        off = n * rows - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    # Around the whole part of the mean the numbers are small again.
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s - n * b for s, b in zip(sums, base.tolist(), strict=True)], np.int64)
    near = rows - base
    bound = n * int(np.abs(near).max(initial=0)) + n
    if bound * bound * max(len(sums), 1) < 1 << 63:
        off = n * near - rest
        return (off * off).sum(axis=1).tolist()
    large = n * near.astype(object) - rest.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (large * large).sum(axis=1)]


def _whitened(whitening: Whitening, error: float):
    mean, scaled = whitening.mean, whitening.scaled()
    shares = whitening.values / whitening.trace if whitening.trace > 0 else np.zeros(len(whitening.values))
    many, n, sums, size = len(whitening.values), whitening.n, whitening.sums, whitening.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _rows(batches, 1, size):
            own = np.repeat(np.arange(len(rows)), many)
            deviation = pa.array(_deviations(rows, n, sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(own)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(own), n)), deviation.take(pa.array(own)), pa.array(((rows - mean) @ scaled).ravel()),
                    pa.array(np.tile(shares, len(rows))), pa.array(np.full(len(own), error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    A vector is usable if it is not null, holds no null, NaN or infinity, and has the commonest
    length (of equally common ones the longest); other rows are left out. Components are those
    of the integers floor(1024 * entry) + 100000 (held within 2^52), numbered from 1 by falling
    eigenvalue, at most ``components`` of them and no more than there are dimensions; their
    largest entry is positive. ``whitened`` is the centred row on the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace; a component without variance
    (up to 1e-12 of the trace) has 0 for both and is left out of ``identity_error``. ``deviation``,
    the sum of (n x - S)^2, is null where a long cannot hold it. Repeated rows and null ids stay;
    a table without usable vectors gives an empty result; other columns are not read.
    """
    plain = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    usable, size = usable_vectors(plain, "vector")
    whitening = fit(usable.select("vector"), size, components)
    error = identity_error(usable.select("vector"), whitening)
    kinds = [
        ("id", plain.schema["id"].dataType), ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
        ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
    ]
    schema = T.StructType([T.StructField(*k) for k in kinds])
    found = usable.where(F.lit(len(whitening.values) > 0)).mapInArrow(_whitened(whitening, error), schema)
    return found.withColumnRenamed("id", id_col)
