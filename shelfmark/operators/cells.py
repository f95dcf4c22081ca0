"""Top-k search that skips the parts of a large corpus that cannot matter.

Each vector belongs to the cell of its most similar pivot. A cell knows its
least similar member, so the angle between a query and its pivot bounds every
score in it. The cells nearest to a query are searched first; then only cells
whose bound reaches its k-th score found are read. The answer is that of a
search of everything, also for vectors that do not cluster: those just skip
less. The corpus is laid out by cell, so a skipped cell is a partition that is
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import stored
from ..sources.tables import write_table
from .catalogue import KEY
from .similarity import (
    SCORES, corpus_blocks, matrix_of, query_blocks, query_vectors, ranked, scored, unit, usable,
)

SLACK = 1e-7


def choose_pivots(
    corpus: DataFrame, number: int, key: str = KEY, vector: str = "embedding"
) -> np.ndarray:
    """Unit vectors of ``number`` corpus rows, the first in order of their hashed keys.

    Pivots and bounds are held on the driver and sent to the tasks: ``number`` sets their size.
    """
    if number < 1:
        raise ValueError("at least one cell")
    first = usable(corpus, key, vector).orderBy(F.xxhash64(key), key).limit(number)
    rows = first.select(vector).collect()
    return unit(np.array([row[0] for row in rows], dtype=np.float64))


def with_cells(
    corpus: DataFrame, pivots: np.ndarray, key: str = KEY, vector: str = "embedding"
) -> DataFrame:
    """(key, vector, cell, near): the most similar pivot and the similarity to it."""
    rows = usable(corpus, key, vector)
    schema = T.StructType(
        [*rows.schema, T.StructField("cell", T.IntegerType()), T.StructField("near", T.DoubleType())]
    )
    count, dim = pivots.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, SCORES // count)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                near = unit(matrix_of(part.column(1), dim)) @ pivots.T
                cells = near.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(cells.astype(np.int32)),
                        pa.array(near[np.arange(len(cells)), cells]),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(assign, schema)


def write_cells(
    corpus: DataFrame,
    name: str,
    pivots: np.ndarray,
    key: str = KEY,
    vector: str = "embedding",
    path: str | None = None,
) -> DataFrame:
    """Write the corpus as a table partitioned by cell.

    It is a new version of the table: a failed write leaves the present one in place.
    The rebalance hint brings the rows of a cell together, and lets adaptive
    execution split a cell that holds many of them over several tasks.
    """
    laid_out = with_cells(corpus, pivots, key, vector).hint("rebalance", "cell")
    return write_table(laid_out, name, path=path, partition_by="cell")


def cell_bounds(cells: DataFrame) -> DataFrame:
    """Per cell its rows and the similarity of its least similar row; keep it with the table."""
    return cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("near").alias("least_near")
    )


def best_matches_by_cell(
    cells: DataFrame,
    pivots: np.ndarray,
    bounds: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = KEY,
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """What ``best_matches`` finds, reading only cells that can hold a match.

    Queries are routed to cells by a join, however many they are. ``where``
    limits the rows that are searched. There is one row of bounds per pivot.
    """
    if where is not None:
        cells = cells.filter(where)
    asked = stored(query_vectors(queries, query_key, query_vector), "queries")
    known = bounds.collect()
    number = np.array([row["cell"] for row in known], dtype=np.int64)
    sizes = np.array([row["rows"] for row in known], dtype=np.int64)
    reach = np.arccos(np.clip([row["least_near"] for row in known], -1, 1))

    def route(vectors: np.ndarray, worst: np.ndarray | None) -> np.ndarray:
        """Which cells each query goes to: first the nearest that fill k, then what may still matter."""
        angles = np.arccos(np.clip(unit(vectors) @ pivots[number].T, -1, 1))
        order = np.argsort(angles, axis=1, kind="stable")
        filled = np.cumsum(sizes[order], axis=1)
        first = np.zeros(angles.shape, dtype=bool)
        np.put_along_axis(first, order, filled - sizes[order] < k, axis=1)
        if worst is None:
            return first
        bound = np.cos(np.maximum(0, angles - reach - SLACK))
        return (bound >= worst[:, None] - SLACK) & ~first

    found = stored(_search(cells, asked, number, route, k, key, vector), "matches")
    last = found.filter(F.col("rank") == k).select(query_key, F.col("score").alias("_worst"))
    more = _search(cells, asked.join(last, query_key, "left"), number, route, k, key, vector)
    return ranked(found.unionByName(more).drop("rank"), k)


def _search(
    cells: DataFrame, asked: DataFrame, number: np.ndarray, route, k: int, key: str, vector: str
) -> DataFrame:
    """The k best rows of each query in those of the cells ``number`` that ``route`` sends it to."""
    query_key = asked.columns[0]
    schema = T.StructType([*asked.schema.fields[:2], T.StructField("slot", T.IntegerType())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix_of(batch.column(1))
            worst = None
            if batch.num_columns > 2:
                worst = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                worst = np.where(np.isnan(worst), -np.inf, worst)
            step = max(1, SCORES // max(1, len(number)))
            for start in range(0, batch.num_rows, step):
                part = slice(start, start + step)
                rows, columns = np.nonzero(route(vectors[part], worst if worst is None else worst[part]))
                taken = batch.take(pa.array(rows + start))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns[:2], pa.array(number[columns].astype(np.int32))], names=schema.names
                )

    blocks = query_blocks(stored(asked.mapInArrow(pairs, schema), "routes"), "slot")
    wanted = blocks.select(F.col("slot").alias("cell")).distinct()
    rows = usable(cells.join(wanted, "cell", "left_semi"), key, vector, "cell")
    return ranked(scored(corpus_blocks(rows), blocks, key, query_key, k), k)

