"""Principal components by a randomised block Krylov space.

A block of random directions, a few more than asked for, is multiplied by the covariance again and again. Each product is one scan: a
task centres a batch of rows, multiplies it by the block and back, and sends one sum per direction; Spark adds the sums
up, for every vector column of the call in the same scan. The products span a space from which the components are taken as soon
as the residual of each is small. The driver holds directions, at most KEPT blocks of them, never a matrix of
columns by columns and never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

MORE = 8  # directions beside those asked for
KEPT = 40  # blocks held before the space is reduced to its best directions
CLOSE = 1e-9  # residual of a component as a share of the largest variance
ROUNDS = 200


@dataclass
class Components:
    """``directions`` (width x k, orthonormal, largest entry positive) and ``variances`` of centred rows, largest first."""

    mean: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    residual: float  # largest norm of C v - variance * v


@dataclass
class _Space:
    mean: np.ndarray
    rows: int
    k: int
    block: np.ndarray
    basis: np.ndarray
    images: np.ndarray  # covariance times basis
    done: Components | None = field(default=None)

    def take(self, image: np.ndarray) -> None:
        """Enlarge the space by the block just multiplied; end, or name the next block."""
        width = len(self.mean)
        self.basis, self.images = np.hstack([self.basis, self.block]), np.hstack([self.images, image])
        values, turns = np.linalg.eigh((self.basis.T @ self.images + self.images.T @ self.basis) / 2)
        order = np.argsort(values)[::-1]
        values, turns = values[order], turns[:, order]
        found, pictures = self.basis @ turns, self.images @ turns
        off = np.linalg.norm(pictures[:, : self.k] - found[:, : self.k] * values[: self.k], axis=0)
        if self.basis.shape[1] >= self.k and off.max(initial=0.0) <= CLOSE * max(values[0], 0.0):
            return self.end(found, values, off)
        new = _independent(image, self.basis)
        if new.shape[1] == 0 or self.basis.shape[1] >= width:
            return self.end(found, values, off)
        if self.basis.shape[1] > (KEPT - 1) * new.shape[1]:  # what is left out stays orthogonal to the next block
            best = 2 * new.shape[1]
            self.basis, self.images = found[:, :best], pictures[:, :best]
        self.block = new

    def end(self, found: np.ndarray, values: np.ndarray, off: np.ndarray) -> None:
        directions = found[:, : self.k]
        top = directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])]
        self.done = Components(self.mean, directions * np.where(top < 0, -1.0, 1.0), np.maximum(values[: self.k], 0), float(off.max(initial=0.0)))


def _independent(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` outside ``basis``; fewer if it adds fewer."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0]


def _rows(column: pa.ListArray, width: int) -> np.ndarray:
    return column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _totals(df: DataFrame, names: list[str]) -> dict[str, tuple[int, np.ndarray]]:
    """Rows and sum of each array column, in one scan; a column without rows is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, c in enumerate(names):
                own = batch.column(c).drop_null()
                if len(own):
                    total = _rows(own, len(own[0])).sum(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([len(own)]), pa.array([total], pa.list_(pa.float64()))], ["col", "n", "v"]
                    )

    sent = df.select(*names).mapInArrow(run, "col int, n long, v array<double>")
    got = sent.groupBy("col").agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    return {names[r["col"]]: (r.n, r.v.toArray()) for r in got}


def covariance_times(df: DataFrame, means: dict[str, np.ndarray], rows: dict[str, int], blocks: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Covariance of each array column of ``df`` times its block, in one scan."""
    names = list(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {c: np.zeros(blocks[c].shape) for c in names}
        for batch in batches:
            for c in names:
                x = _rows(batch.column(c), len(means[c])) - means[c]
                sums[c] += x.T @ (x @ blocks[c])
        at = [(i, j) for i, c in enumerate(names) for j in range(blocks[c].shape[1])]
        vectors = [v for c in names for v in sums[c].T]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()), pa.array(vectors, pa.list_(pa.float64()))],
            ["col", "direction", "v"],
        )

    sent = df.select(*names).mapInArrow(run, "col int, direction int, v array<double>")
    got = sent.groupBy("col", "direction").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    out = {c: np.zeros(blocks[c].shape) for c in names}
    for r in got:
        c = names[r["col"]]
        out[c][:, r.direction] = r.v.toArray() / max(rows[c], 1)
    return out


def _arrays(df: DataFrame, vectors: dict[str, str]) -> DataFrame:
    """Arrays instead of vectors; one that holds NaN or an infinity is null."""
    odd = lambda x: F.isnan(x) | (F.abs(x) == float("inf"))
    found = [F.when(F.col(v).isNotNull(), vector_to_array(F.coalesce(v, array_to_vector(F.array(F.lit(0.0)))))).alias(name) for name, v in vectors.items()]
    return df.select("id", *found).select("id", *(F.when(~F.exists(n, odd), F.col(n)).alias(n) for n in vectors))


def fit_components(df: DataFrame, k: int, vectors: dict[str, str] | None = None, seed: int = 1122) -> dict[str, Components]:
    """The first ``k`` components of each vector column, fewer if it is narrower. Rows without a vector, or with NaN in it, count for none.

    All vectors of a column have one width. Without rows there are no components.
    """
    vectors = vectors or {"pca": "features"}
    rows = _arrays(df, vectors)
    spaces: dict[str, _Space] = {}
    for n, (count, total) in _totals(rows, list(vectors)).items():
        width = len(total)
        draw = np.random.default_rng([seed, list(vectors).index(n)]).normal(size=(width, min(width, k + MORE)))
        none = np.zeros((width, 0))
        spaces[n] = _Space(total / count, count, min(k, width), np.linalg.qr(draw)[0], none, none)
    for _ in range(ROUNDS):
        open_ = {n: s for n, s in spaces.items() if s.done is None}
        if not open_:
            break
        got = covariance_times(rows, {n: s.mean for n, s in open_.items()}, {n: s.rows for n, s in open_.items()}, {n: s.block for n, s in open_.items()})
        for n, s in open_.items():
            s.take(got[n])
    if any(s.done is None for s in spaces.values()):
        raise RuntimeError(f"components not found in {ROUNDS} scans")
    return {n: s.done for n, s in spaces.items()}


def pca_features(df: DataFrame, k: int | tuple[int, ...], vectors: dict[str, str] | None = None) -> DataFrame:
    """Projections of the centred rows on the first components: ``id, pca<k>_0, ...`` for each number in ``k``.

    ``vectors`` names the vector columns by the prefix of their results. A column is fitted once, for the largest
    number: fewer components are the first of these. All columns are projected in one scan. A row without a
    vector, or with NaN in it, has null; so has a component that a column is too narrow for.
    """
    sizes = (k,) if isinstance(k, int) else tuple(k)
    vectors = vectors or {"pca": "features"}
    found, names, most = fit_components(df, max(sizes), vectors), list(vectors), max(sizes)
    schema = StructType([df.schema["id"], *(StructField(n, ArrayType(DoubleType())) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [batch.column("id")]
            for n in names:
                column, values = batch.column(n), [None] * len(batch)
                if n in found:
                    scores = (_rows(column, len(found[n].mean)) - found[n].mean) @ found[n].directions
                    for i, s in zip(np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)), scores, strict=True):
                        values[i] = s
                out.append(pa.array(values, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(out, ["id", *names])

    scored = _arrays(df, vectors).mapInArrow(run, schema)
    return scored.select("id", *(F.get(n, F.lit(i)).alias(f"{n}{size}_{i}") for n in names for size in sizes for i in range(size) if i < most))
