"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The components are right singular vectors of the matrix X of centred rows. Starting from a vector v,
the method alternates u = Xv and v = X'u, keeps all u and all v orthogonal, and ends with a small
bidiagonal matrix whose singular values and vectors give those of X. Rows stay where they are: one
pass over the stored rows gives Xv and X'(Xv) at once, added up per task. Each u is X times a short
vector p, so p is kept in its place, and as w = X'u is known for all former u, so is u_j'Xv = w_j'v:
the left vectors are made orthogonal without another pass. Every pass also measures how orthogonal
the new u is to all former ones, and is repeated with this taken out where it is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import column

COMPONENTS = 4
SCALE = 256
# Rows of a stored block, of dim numbers each.
BLOCK_ROWS = 4096
# Entries beyond this are kept at it: far above any embedding, and block sums stay exact.
LARGEST = 1 << 50
# A triplet counts as found when its residual is below this share of the largest singular value.
RESIDUAL = 1e-14
# Further steps, from a fresh start, that must leave the components as they are.
CONFIRM = 6
ORTHOGONAL = 1e-13


@dataclass
class Whitening:
    """What is fitted: size of the fit list, exact sums, components as columns, eigenvalues, trace, error."""

    dim: int
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    error: float | None
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], np.float64)


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): floor(256 c) of each entry c, of the rows whose entries are all there and finite."""
    entry = F.col("v")
    rows = vectors.select(column(vec_id).alias("vec_id"), column(vector).cast("array<double>").alias("v"))
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(
        entry, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    )
    return rows.where(entry.isNotNull() & (F.size(entry) > 0) & finite).select("vec_id", whole.alias("x"))


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _blocks(distinct: DataFrame, dim: int) -> DataFrame:
    """(n, rows, sums): up to BLOCK_ROWS vectors as the bytes of longs, and their sums."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = _matrix(part.column(0), dim)
                sums = [sum(c) for c in x.T.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary()),
                        pa.array([sums], pa.list_(pa.decimal128(38, 0))),
                    ],
                    names=["n", "rows", "sums"],
                )

    return distinct.select("x").mapInArrow(pack, "n long, rows binary, sums array<decimal(38,0)>")


def _added(blocks: DataFrame, work, width: int) -> np.ndarray:
    """The sum over all blocks of ``work(x)``, ``width`` numbers: added per task, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for rows in batch["rows"]:
                total += work(np.frombuffer(rows.as_buffer(), np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["i", "x"]
        )

    parts = blocks.select("rows").mapInArrow(run, "i int, x double")
    total = np.zeros(width)
    for i, x in parts.groupBy("i").agg(F.sum("x")).collect():
        total[i] = x
    return total


def fit(
    vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 0
) -> Whitening | None:
    """Fit on each distinct vector once; None if no row can be used.

    Vectors of another length than most (of equally frequent lengths the longest) take no part.
    Components of no variance are left out, so there may be fewer than asked for. The driver holds
    vectors of one row's length and at most two of them a step, never rows.
    """
    rows = whole_vectors(vectors, vec_id, vector)
    lengths = rows.groupBy(F.size("x").alias("dim")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return None
    dim = most["dim"]
    distinct = rows.where(F.size("x") == dim).groupBy("x").agg(F.lit(1).alias("one")).select("x")
    blocks = stored(_blocks(distinct, dim), "whitening-blocks")
    entries = blocks.select("n", F.posexplode("sums").alias("i", "s"))
    sums, n = [0] * dim, 0
    for i, s, number in entries.groupBy("i").agg(F.sum("s"), F.sum("n")).collect():
        sums[i], n = int(s), number
    mean = np.array([s / n for s in sums], np.float64)

    def centred(block: np.ndarray) -> np.ndarray:
        return block.reshape(-1, dim) - mean

    components_, values, trace, steps = _bidiagonalised(blocks, centred, dim, n, components, seed)
    model = Whitening(dim, n, sums, components_, values, trace, None, steps)
    model.error = _identity_error(blocks, centred, model)
    return model


def _bidiagonalised(blocks: DataFrame, centred, dim: int, n: int, wanted: int, seed: int):
    """(components, eigenvalues, trace, steps) of the covariance of the centred rows."""
    random = np.random.default_rng(seed)
    V: list[np.ndarray] = []  # right vectors
    P: list[np.ndarray] = []  # left vector j is X P[j]
    W: list[np.ndarray] = []  # X' times left vector j
    B = np.zeros((0, 0))  # W'V: the bidiagonal matrix, up to rounding

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in V:
                v = v - (other @ v) * other
        return v

    def product(p: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, float]:
        """X'Xp, |Xp|^2, the products of Xp with all left vectors, and |X|^2, in one pass."""
        basis = np.array([p, *P]).T

        def work(block: np.ndarray) -> np.ndarray:
            x = centred(block)
            u = x @ basis
            return np.concatenate([x.T @ u[:, 0], u.T @ u[:, 0], [np.vdot(x, x)]])

        total = _added(blocks, work, dim + basis.shape[1] + 1)
        return total[:dim], total[dim], total[dim + 1 : -1], total[-1]

    v = orthogonal(random.standard_normal(dim))
    v /= np.linalg.norm(v)
    square = 0.0
    confirming = None
    found = np.zeros((dim, 0)), np.zeros(0)
    while True:
        # u = Xv without its parts along former left vectors, whose products with Xv are known.
        p = v - sum(((w @ v) * q for w, q in zip(W, P)), np.zeros(dim))
        z, length, along, square = product(p)
        if length > 0 and P and np.abs(along).max() > ORTHOGONAL * np.sqrt(length):
            p = p - sum((a * q for a, q in zip(along, P)), np.zeros(dim))
            z, length, along, square = product(p)
        V.append(v)
        alpha = np.sqrt(max(length, 0.0))
        floor = np.sqrt(square) * 1e-13
        if alpha > floor:
            P.append(p / alpha)
            W.append(z / alpha)
        # The small matrix has the products of left vectors and Xv; but for rounding it is bidiagonal.
        B = np.array([[w @ r for r in V] for w in W]).reshape(len(W), len(V))
        rest = orthogonal(W[-1]) if alpha > floor else np.zeros(dim)
        beta = np.linalg.norm(rest)
        left, sigma, right = np.linalg.svd(B, full_matrices=False)
        count = min(wanted, int((sigma > floor).sum()))
        found = (np.array(V).T @ right[:count].T, sigma[:count] ** 2 / n)
        exhausted = len(V) == dim
        residual = beta * np.abs(left[-1, :count]) if len(left) and alpha > floor else np.zeros(count)
        converged = count == min(wanted, dim) and bool(
            (residual <= RESIDUAL * (sigma[0] if count else 0)).all()
        )
        if exhausted:
            break
        if beta > floor and not converged:
            v = rest / beta
            if confirming is not None:
                confirming -= 1
            continue
        # Nothing more comes from this start, or the components stand. One vector meets only one
        # direction of equal values, so a fresh start must leave them as they are.
        if converged and confirming is not None and confirming <= 0:
            break
        if confirming is None or beta <= floor:
            confirming = CONFIRM if confirming is None else confirming - 1
            v = orthogonal(random.standard_normal(dim))
            v /= np.linalg.norm(v)
        else:
            confirming -= 1
            v = rest / beta
    return found[0], found[1], square / n, len(V)


def _projection(x: np.ndarray, model_components: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (x @ model_components) / np.sqrt(values)


def _identity_error(blocks: DataFrame, centred, model: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus the identity; None without components."""
    k = len(model.values)
    if not k:
        return None
    components, values, n = model.components, model.values, model.n

    def sums(block: np.ndarray) -> np.ndarray:
        return _projection(centred(block), components, values).sum(axis=0)

    middle = _added(blocks, sums, k) / n

    def squares(block: np.ndarray) -> np.ndarray:
        y = _projection(centred(block), components, values) - middle
        return (y.T @ y).ravel()

    covariance = _added(blocks, squares, k * k).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(
    vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Every usable row on every component.

    Returns ``vec_id, component`` (from 1, by falling eigenvalue), ``n, deviation`` (sum over
    dimensions of (n x - S)^2, exact; null beyond a long), ``whitened, explained, identity_error``.
    Rows without a vector, with null or non-finite entries or of another length than the fitted ones
    are left out; repeated rows come as often as they are there. Without variance there is no
    component, hence no row. Entries beyond 2^50 after scaling are kept at that. One scan.
    """
    rows = whole_vectors(vectors, vec_id, vector)
    kind = dict(rows.dtypes)["vec_id"]
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if model is None:
        return rows.limit(0).selectExpr("vec_id").mapInArrow(lambda batches: iter(()), schema)
    dim, n, sums, mean = model.dim, model.n, model.sums, model.mean
    components, values, trace, error = model.components, model.values, model.trace, model.error
    k = len(values)
    largest = max(abs(s) for s in sums)

    def deviations(x: np.ndarray) -> list[int | None]:
        if (n * int(np.abs(x).max()) + largest) ** 2 * dim < 1 << 62:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch["x"], dim)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(_projection(x - mean, components, values).ravel()),
                    pa.array(np.tile(values / trace if trace else values, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == dim).mapInArrow(run, schema)
