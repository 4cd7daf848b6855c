"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers first, so their sums are exact. Each pass over the centred rows gives
their Gram matrix, added up by cell over all tasks; its Cholesky factor orthogonalises the rows by a
triangular solve, in the tasks of the next pass. The first matrix is shifted, so that it has a factor
whatever its condition, and so is a later one that has none; passes go on until the rows are
orthonormal. The composed factors are a triangular R with the same singular values and right vectors
as the rows, and the components come from its singular value decomposition.

The driver holds matrices of dimensions by dimensions only, whose number is checked.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are left out,
and so are those whose length is not the most frequent one (of equally frequent lengths the longest);
null ids and repeated rows stay rows of their own; directions without variance have no component, so
fewer than two different vectors give no rows, and neither does an empty table; numbers beyond 62 bits
are cut off there, and a deviation beyond 63 bits is null; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import map_arrow
from reelstat.session import written

MAX_DIMENSIONS = 4096
#: Passes, and how far from the identity the Gram matrix of orthonormal rows may be.
PASSES, NEAR = 6, 1e-11
#: Singular values below this share of the largest are rounding errors.
NOTHING = 1e-11
#: Columns that a triangular solve works on together.
STRIP = 32

SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def numbers_of(column: pa.Array, scale: float, offset: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows with a usable vector, and for each floor(scale * entry) + offset."""
    values = pc.cast(column.flatten(), pa.float64())
    valid = np.isfinite(values.fill_null(np.nan).to_numpy(zero_copy_only=False))
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~valid)))
    rows = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
    most = float(1 << 62)
    scaled = np.floor(scale * np.where(valid, values.fill_null(0).to_numpy(zero_copy_only=False), 0.0))
    whole = np.clip(scaled + offset, -most, most).astype(np.int64)
    near = np.abs(scaled) < 2.0**52  # beyond, a double has no digits for the offset
    whole[near] = scaled[near].astype(np.int64) + offset
    return rows, [whole[ends[i] - sizes[i] : ends[i]] for i in rows]


def prepared(vectors: DataFrame, id_column: str, vector_column: str, scale: float, offset: int) -> DataFrame:
    """(id, size, x) of the usable rows, x being the numbers' bytes."""

    def rows(batch: pa.RecordBatch) -> dict:
        at, found = numbers_of(batch.column(1), scale, offset)
        return {
            "id": batch.column(0).take(pa.array(at)),
            "size": pa.array([len(x) for x in found], pa.int32()),
            "x": pa.array([x.tobytes() for x in found], pa.binary()),
        }

    kind = vectors.schema[id_column].dataType.simpleString()
    slim = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))
    return map_arrow(slim, rows, f"id {kind}, size int, x binary")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), -1)


def added(
    rows: DataFrame, cells: Callable[[np.ndarray], np.ndarray], kind: type = np.float64
) -> np.ndarray:
    """The sum over all rows of what ``cells`` gives for a batch: each task adds up its own, then
    they are added by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = cells(matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total.astype(kind))], ["cell", "n"]
            )

    name = "long" if kind is np.int64 else "double"
    sums = rows.select("x").mapInArrow(run, f"cell long, n {name}")
    found = sums.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    return found.column(1).to_numpy()


def halves(x: np.ndarray) -> np.ndarray:
    """Sums of the upper and lower 32 bits of each column, which do not overflow."""
    return np.concatenate(((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)))


@dataclass(frozen=True)
class Centre:
    """How many rows there are, and the exact sums of their columns."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums; as Python's numbers where a long is too short."""
        bound = float(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        if bound < 2.0**62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squares(self, x: np.ndarray) -> pa.Array:
        found = self.deviations(x)
        if found.dtype == object or float(np.abs(found).max(initial=0)) ** 2 * x.shape[1] >= 2.0**62:
            sums = (int(s) for s in (found.astype(object) ** 2).sum(axis=1))
            return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
        return pa.array((found * found).sum(axis=1), pa.int64())


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, strip by strip."""
    out = rows.copy()
    for begin in range(0, len(r), STRIP):
        end = min(begin + STRIP, len(r))
        if begin:
            out[:, begin:end] -= out[:, :begin] @ r[:begin, begin:end]
        for j in range(begin, end):
            if j > begin:
                out[:, j] -= out[:, begin:j] @ r[begin:j, j]
            out[:, j] /= r[j, j]
    return out


def orthogonalised(x: np.ndarray, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    rows = centre.centred(x)
    for r in factors:
        rows = solved(rows, r)
    return rows


def factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor, of the shifted matrix if asked for or needed."""
    size = len(gram)
    shift = 11 * (n * size + size * (size + 1)) * 2.0**-53 * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(size)).T


def triangular(rows: DataFrame, centre: Centre) -> np.ndarray:
    """A matrix with the singular values and right vectors of the centred rows."""
    size = len(centre.sums)
    factors: list[np.ndarray] = []
    while True:
        def gram_of(x, own=tuple(factors)):
            q = orthogonalised(x, centre, own)
            return (q.T @ q).ravel()

        gram = added(rows, gram_of).reshape(size, size)
        gram = (gram + gram.T) / 2
        if not gram.any():
            return gram
        if len(factors) == PASSES or factors and np.abs(gram - np.eye(size)).max() <= NEAR:
            break
        factors.append(factor(gram, centre.n, not factors))
    # What the last pass has left, by a square root that also exists without full rank.
    values, vectors = np.linalg.eigh(gram)
    out = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    for r in reversed(factors):
        out = out @ r
    return out


def components_of(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors by falling variance, the variances, and their shares of the whole."""
    _, values, vectors = np.linalg.svd(r)
    count = min(most, int((values > NOTHING * values[0]).sum())) if values[0] > 0 else 0
    vectors, squares = vectors[:count], values**2
    # Of the two signs the one that makes the largest entry positive.
    signs = np.sign(vectors[np.arange(count), np.abs(vectors).argmax(axis=1)])
    return vectors * signs[:, None], squares[:count] / n, squares[:count] / (squares.sum() or 1.0)


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    components: int = 32, scale: float = 64.0, offset: int = 1_000_000,
) -> DataFrame:
    """One row for each usable row and component: id, component (from 1), n, deviation (the exact sum
    of squares of n * x - sums), whitened, explained, identity_error."""
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, {SCHEMA}"
    found = written(prepared(vectors, id_column, vector_column, scale, offset), "whitening-rows")
    common = found.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, n = common
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {size} entries; the driver holds {MAX_DIMENSIONS} squared at most")
    rows = found.filter(F.col("size") == size)
    parts = added(rows, halves, np.int64)
    centre = Centre(n, tuple((int(a) << 32) + int(b) for a, b in zip(parts[:size], parts[size:])))
    axes, variances, explained = components_of(triangular(rows, centre), n, components)
    k = len(axes)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    roots = np.sqrt(variances)

    def projected(x: np.ndarray) -> np.ndarray:
        return centre.centred(x) @ axes.T / roots

    def moments(x: np.ndarray) -> np.ndarray:
        y = projected(x)
        return np.concatenate((y.sum(axis=0), (y.T @ y).ravel()))

    sums = added(rows, moments)
    mean, squares = sums[:k] / n, sums[k:].reshape(k, k) / n
    error = float(np.abs(squares - np.outer(mean, mean) - np.eye(k)).max())

    def out(batch: pa.RecordBatch) -> Iterator[dict]:
        x = matrix(batch.column(1))
        at = pa.array(np.repeat(np.arange(len(x)), k))
        yield {
            id_column: batch.column(0).take(at),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            "n": pa.array(np.full(len(x) * k, n)), "deviation": centre.squares(x).take(at),
            "whitened": pa.array(projected(x).ravel()),
            "explained": pa.array(np.tile(explained, len(x))),
            "identity_error": pa.array(np.full(len(x) * k, error)),
        }

    return map_arrow(rows.select("id", "x"), out, schema)
