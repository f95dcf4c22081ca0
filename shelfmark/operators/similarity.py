"""Exact top-k similarity search."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import stored
from .catalogue import KEY

# Scores are compared to this many decimals, so that equal vectors tie whatever
# batch they are in, and the key decides between them.
DIGITS = 9
# Query vectors and corpus vectors of a block, and scores held in a task at a time.
QUERIES = 1024
ROWS = 4096
SCORES = 1 << 20
SALTS = 64


def best_matches(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = KEY,
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """The k most cosine-similar corpus rows of each query: query, rank, key, score.

    Every corpus row is scored and no pair is ever a row. Both sides are packed
    in blocks of bounded size; every block of queries meets every block of the
    corpus in a join on a slot, and only the k best per query of two blocks go
    on. Queries are stored once; few enough, Spark broadcasts their blocks, and
    the corpus is scanned in place. ``where`` filters the corpus at the scan.
    Query keys must be distinct, else the search fails when it runs. A vector of
    length 0, or with a number missing, scores 0. Scores are computed from
    single-precision corpus vectors; doubles are rounded to these.
    """
    if where is not None:
        corpus = corpus.filter(where)
    slots = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = query_blocks(stored(query_vectors(queries, query_key, query_vector), "queries"))
    spread = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    found = scored(corpus_blocks(usable(corpus, key, vector), slots), spread, key, query_key, k)
    return ranked(found, k)


def query_vectors(queries: DataFrame, query_key: str, query_vector: str) -> DataFrame:
    known = queries.filter(F.col(query_key).isNotNull() & F.col(query_vector).isNotNull())
    return known.select(query_key, F.col(query_vector).cast("array<double>").alias("_vector"))


def query_blocks(asked: DataFrame, by: str | None = None) -> DataFrame:
    """Blocks of about QUERIES (key, vector) pairs, none with more than one ``by``."""
    query_key = asked.columns[0]
    number = max(1, -(-asked.count() // QUERIES))
    block = F.pmod(F.xxhash64(query_key), F.lit(number))
    keys = [by] if by else []
    once = asked.groupBy(query_key, *keys).agg(
        F.when(F.count("*") > 1, F.raise_error(F.lit("query keys must be distinct")))
        .otherwise(F.min("_vector")).alias("_vector")
    )
    packed = once.groupBy(*keys, block.alias("_block")).agg(
        F.collect_list(F.struct(query_key, "_vector")).alias("queries")
    )
    return stored(packed.drop("_block"), "query-blocks")


def usable(corpus: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """(key, vector) of the rows that can be found, and ``more`` columns."""
    known = corpus.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    return known.select(F.col(key), F.col(vector).cast("array<float>").alias(vector), *more)


def corpus_blocks(rows: DataFrame, slots: int | None = None) -> DataFrame:
    """(slot, keys, vectors): up to ROWS rows of (key, vector), dealt over slots in turn.

    Without ``slots`` the rows have a third column, the slot, which they keep.
    """
    key = rows.schema[0].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            if slots is None:
                given = batch.column(2).to_numpy(zero_copy_only=False)
                batch = batch.take(pa.array(np.argsort(given, kind="stable")))
                given = np.sort(given, kind="stable")
                cuts = [0, *(np.flatnonzero(np.diff(given)) + 1).tolist(), batch.num_rows]
            else:
                cuts = [0, batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                for start in range(a, b, ROWS):
                    part = batch.slice(start, min(ROWS, b - start))
                    one = pa.array([0, part.num_rows], pa.int32())
                    slot = turn % slots if slots is not None else int(given[start])
                    turn += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([slot], pa.int32()), *(pa.ListArray.from_arrays(one, c) for c in part.columns[:2])],
                        names=["slot", "keys", "vectors"],
                    )

    return rows.mapInArrow(pack, f"slot int, keys array<{key}>, vectors array<array<float>>")


def scored(
    corpus: DataFrame, blocks: DataFrame, key: str, query_key: str, k: int, counter: Accumulator | None = None
) -> DataFrame:
    """(query, key, score): the k best of each query in every two blocks that share a slot.

    ``counter`` adds up the scores computed.
    """
    schema = T.StructType(
        [
            T.StructField(query_key, blocks.schema["queries"].dataType.elementType[0].dataType),
            T.StructField(key, corpus.schema["keys"].dataType.elementType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    pairs = corpus.join(blocks, "slot").select("keys", "vectors", "queries")
    return pairs.mapInArrow(_scorer(schema, k, counter), schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query, key, score) per query, first among groups of tasks, then of those."""
    query_key, key = found.columns[:2]
    best = [F.col("score").desc(), F.col(key)]
    part = Window.partitionBy(query_key, "_salt").orderBy(*best)
    whole = Window.partitionBy(query_key).orderBy(*best)
    return (
        found.withColumn("_salt", F.spark_partition_id() % SALTS)
        .withColumn("rank", F.row_number().over(part))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(whole))
        .filter(F.col("rank") <= k)
        .select(query_key, "rank", key, "score")
    )


def unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    usable = np.isfinite(length) & (length > 0)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=usable)


def matrix_of(vectors: pa.ListArray, dim: int | None = None) -> np.ndarray:
    """A list column as doubles; all rows must have as many numbers."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    dim = dim or (len(flat) // len(vectors) if len(vectors) else 0)
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths != dim).any():
        raise ValueError(f"vectors must have {dim} numbers")
    return flat.reshape(len(vectors), dim).astype(np.float64)


def cosines(units: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Rounded scores of unit vectors against others; 0 where a length is no number above 0."""
    with np.errstate(invalid="ignore"):
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        products = units @ vectors.T
    good = np.isfinite(length) & (length > 0)
    ratio = np.divide(products, length, out=np.zeros_like(products), where=good)
    return np.round(ratio, DIGITS) + 0.0


def best_of(scores: np.ndarray, keys: Sequence, k: int) -> Sequence[int]:
    """Places of the k best scores, of equal ones those of the smallest keys."""
    if len(scores) <= k:
        return range(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge).tolist()
    level = np.flatnonzero(scores == edge).tolist()
    return above + heapq.nsmallest(k - len(above), level, key=keys.__getitem__)


def _scorer(schema: T.StructType, k: int, counter: Accumulator | None = None):
    """Score pairs of blocks with one matrix product per piece, keep the k best per query."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, vectors, queries in zip(*(batch.column(i) for i in range(3))):
                keys, vectors, queries = keys.as_py(), matrix_of(vectors.values), queries.values
                names, asked = queries.field(0).to_pylist(), matrix_of(queries.field(1), vectors.shape[1])
                out: list[list] = [[], [], []]
                step = max(1, SCORES // max(1, len(keys)))
                if counter is not None:
                    counter.add(len(keys) * len(names))
                for start in range(0, len(names), step):
                    for name, row in zip(names[start:], cosines(unit(asked[start : start + step]), vectors)):
                        chosen = best_of(row, keys, k)
                        out[0] += [name] * len(chosen)
                        out[1] += [keys[i] for i in chosen]
                        out[2] += [float(row[i]) for i in chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=field.type) for c, field in zip(out, arrow)], schema=arrow
                )

    return score
