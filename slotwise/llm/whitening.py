"""Operator 11: whitening of embeddings by a polarisation covariance.

Method. Every vector is put on an integer grid. For every dimension i, and for
the sum of every pair of dimensions (i, j), the exact sum of squared centred
values is aggregated over the distinct vectors. By the polarisation identity

    2 cov(i, j) = var(i + j) - var(i) - var(j)

the differences of these variances give every covariance. They are integers until
the last division, so no digits are lost to the large common offset of the grid.
``eigh`` of the assembled matrix gives the components.

Squares are centred before they are made: around the mean rounded to a whole
number (one per dimension, from a first pass), whose rest is taken off exactly on
the driver. Sums that could leave 64 bits are made of Python integers.

What reaches the driver has the size of the matrix (dimensions squared), whatever
the number of rows. Tasks send one row per entry, added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import quoted, stored, with_fields

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Grid values beyond this are set to it, so that any finite component has one.
GRID_LIMIT = 1 << 48
#: Vectors of a block that is squared at once.
BLOCK = 4096
#: Eigenvalues below this share of the largest one are rounding errors of zero.
FLAT = 1e-12
SUMS = "i int, j int, total decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """The fit list's figures: size, sums, covariance and its components by falling eigenvalue."""

    n: int
    sums: list[int]
    pivot: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray

    @property
    def spread(self) -> np.ndarray:
        """Which components have any variance."""
        return self.values > FLAT * max(float(self.values[0]), 0.0) if len(self.values) else np.zeros(0, bool)


# --- the integer grid ------------------------------------------------------------------


def grid(vectors: np.ndarray) -> np.ndarray:
    """``floor(64 * c)`` as int64 (the offset is added where sums are reported)."""
    return np.floor(SCALE * vectors.astype(np.float64)).clip(-GRID_LIMIT, GRID_LIMIT).astype(np.int64)


def pack(row: np.ndarray) -> bytes:
    """A grid vector as bytes: its width, then its entries in the narrowest width that holds them all."""
    for width in (1, 2, 4):
        if not len(row) or (row.min() >= -(1 << 8 * width - 1) and row.max() < 1 << 8 * width - 1):
            return bytes((width,)) + row.astype(f"<i{width}").tobytes()
    return b"\x08" + row.astype("<i8").tobytes()


def unpack(codes: Iterable[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(c, f"<i{c[0]}", offset=1) for c in codes], dtype=np.int64)


def coded(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dims, code`` of every row whose vector is not null and holds finite numbers only."""
    rows = df.select(quoted(id_col).alias("id"), quoted(vector_col).cast("array<double>").alias("vector")).where("vector is not null")
    schema = with_fields(rows.select("id"), "dims int, code binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keep, dims, codes = batch.column(0), [], [], []
            for at, vector in enumerate(batch.column(1)):
                entries = vector.values
                if entries.null_count == 0 and np.isfinite(row := entries.to_numpy(zero_copy_only=False)).all():
                    keep.append(at)
                    dims.append(len(row))
                    codes.append(pack(grid(row)))
            taken = ids.take(pa.array(keep, pa.int64()))
            yield pa.record_batch([taken, pa.array(dims, pa.int32()), pa.array(codes, pa.binary())], names=["id", "dims", "code"])

    return rows.mapInArrow(run, schema)


# --- exact sums ------------------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        codes = batch.column(0).to_pylist()
        for at in range(0, len(codes), BLOCK):
            yield unpack(codes[at : at + BLOCK])


def _rows(entries: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    keys = list(entries)
    columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32())]
    columns.append(pa.array([Decimal(entries[k]) for k in keys], pa.decimal128(38, 0)))
    yield pa.record_batch(columns, names=["i", "j", "total"])


def _safe(block: np.ndarray, peak: int) -> np.ndarray:
    """``block`` as Python integers if sums of its rows, of entries up to ``peak``, could leave 64 bits."""
    return block if peak * max(len(block), 1) < 1 << 62 else block.astype(object)


def plain_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors, and the sum of every dimension."""

    def run(batches):
        count, total = 0, [0] * dims
        for block in _blocks(batches):
            block = _safe(block, int(np.abs(block).max(initial=0)))
            count += len(block)
            total = [a + int(b) for a, b in zip(total, block.sum(axis=0))]
        yield from _rows({(-1, -1): count} | {(i, i): t for i, t in enumerate(total)})

    got = {r["i"]: int(r["total"]) for r in fit.mapInArrow(run, SUMS).groupBy("i").agg(F.sum("total").alias("total")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dims)]


def squared_sums(fit: DataFrame, pivot: list[int]) -> dict[tuple[int, int], int]:
    """Sums of ``(x_i - p_i)^2`` at (i, i), of ``(x_i - p_i + x_j - p_j)^2`` at (i, j), i < j."""
    dims = len(pivot)

    def run(batches):
        at, total = np.array(pivot, dtype=np.int64), {}
        for block in _blocks(batches):
            block = block - at
            block = _safe(block, (2 * int(np.abs(block).max(initial=0))) ** 2)
            for i in range(dims):
                pair = block[:, i:] + block[:, i : i + 1]
                pair[:, 0] = block[:, i]  # the dimension alone, not its double
                for j, t in enumerate((pair * pair).sum(axis=0).tolist(), i):
                    total[i, j] = total.get((i, j), 0) + t
        yield from _rows(total)

    sums = fit.mapInArrow(run, SUMS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in sums.collect()}


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, divisor ``n``, from squares around a pivot and the sums ``rest`` around it."""
    dims = len(rest)
    var = {k: n * s - (rest[k[0]] + (rest[k[1]] if k[0] != k[1] else 0)) ** 2 for k, s in squares.items()}  # n^2 times the variance
    out = np.zeros((dims, dims))
    for (i, j), v in var.items():
        twice = 2 * v if i == j else v - var[i, i] - var[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)  # of Python integers: rounded once
    return out


def fit_whitening(fit: DataFrame, dims: int) -> Fit:
    """Components of the distinct vectors ``fit(code)``."""
    n, sums = plain_sums(fit, dims)
    pivot = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * p for s, p in zip(sums, pivot)]
    cov = covariance(n, rest, squared_sums(fit, pivot))
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    return Fit(n, sums, pivot, cov, values[order], axes[:, order])


# --- results ---------------------------------------------------------------------------


def _project(block: np.ndarray, fit: Fit, k: int) -> np.ndarray:
    """Whitened values of the first ``k`` components; a component without variance has none (nan)."""
    rest = np.array([(s - fit.n * p) / fit.n for s, p in zip(fit.sums, fit.pivot)])
    centred = (block - np.array(fit.pivot, dtype=np.int64)).astype(np.float64) - rest
    scale = np.where(fit.spread[:k], np.sqrt(np.where(fit.spread[:k], fit.values[:k], 1.0)), np.nan)
    return centred @ fit.axes[:, :k] / scale


def identity_error(fit_list: DataFrame, fit: Fit, k: int) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity); None without any variance."""
    alive = int(fit.spread[:k].sum())
    if not alive:
        return None

    def run(batches):
        first, second = np.zeros(alive), np.zeros((alive, alive))
        for block in _blocks(batches):
            values = _project(block, fit, alive)
            first += values.sum(axis=0)
            second += values.T @ values
        table = np.vstack([first, second])
        i, j = np.indices(table.shape)
        yield pa.record_batch([pa.array(i.ravel() - 1, pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(table.ravel())], names=["i", "j", "total"])

    got = fit_list.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    table = np.zeros((alive + 1, alive))
    for r in got:
        table[r["i"] + 1, r["j"]] = r["total"] / fit.n
    return float(np.abs(table[1:] - np.outer(table[0], table[0]) - np.eye(alive)).max())


def _deviations(block: np.ndarray, fit: Fit) -> list[int]:
    """Exact sums over the dimensions of ``(n * x - S)^2``."""
    shift = np.array([s - fit.n * p for s, p in zip(fit.sums, fit.pivot)], dtype=object)  # below n each
    block = block - np.array(fit.pivot, dtype=np.int64)
    peak = (fit.n * int(np.abs(block).max(initial=0)) + fit.n) ** 2 * max(block.shape[1], 1)
    scaled = block * fit.n - shift.astype(np.int64) if peak < 1 << 62 else block.astype(object) * fit.n - shift
    return (scaled * scaled).sum(axis=1).tolist()


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` for every vector and component.

    Rows whose vector is null or holds a null or non-finite entry have no result,
    nor have vectors of another length than the commonest one (ties: the longer),
    for they lie in no common space. Equal vectors count once in the fit and get a
    result each; ids may be null or repeat. With fewer dimensions than
    ``components`` there is one component per dimension. A component without
    variance (all vectors equal along it) has ``whitened`` null; without any
    variance ``explained`` and ``identity_error`` are null too. An empty table, or
    one of empty vectors, gives an empty table. Grid values are held within 2^48.
    ``deviation`` is a decimal: beyond 38 digits it is null.
    """
    rows = stored(coded(df, id_col, vector_col), "white-codes")
    lengths = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0]["dims"] if lengths else 0
    rows = rows.where(F.col("dims") == dims).select("id", "code")
    k = min(components, dims)
    schema = with_fields(
        rows.select("id"), "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    fit_list = stored(rows.select("code").distinct(), "white-fit")
    fit = fit_whitening(fit_list, dims)
    error, trace = identity_error(fit_list, fit, k), float(np.trace(fit.covariance))
    explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in fit.values[:k]]
    limit = 10**38

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                block, m = unpack(part.column(1).to_pylist()), part.num_rows
                deviation = pa.array([Decimal(d) if d < limit else None for d in _deviations(block, fit)], pa.decimal128(38, 0))
                values = _project(block, fit, k).ravel()
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fit.n, dtype=np.int64)),
                        deviation.take(each),
                        pa.array(values, mask=np.isnan(values)),
                        pa.array(explained * m, pa.float64()),
                        pa.array([error] * (m * k), pa.float64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
