"""From a packing of lengths to a place for every piece.

A packing needs no more of the pieces than how many there are of each length, and there are no
more lengths than tokens in a sequence. So the packers work on these counts: they return runs of
equal decisions, and each piece finds its own by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import free_memory
from .tokens import WordEncoder

# Pieces of one length are ranked in as many separate cells.
CELLS = 64


class Run(NamedTuple):
    """Pieces ``first`` to ``first + number - 1`` of a length go to sequences from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    number: int
    sequence: int
    offset: int


def pieces(slim: DataFrame, tokenizer: str, limit: int, end: int = 0) -> DataFrame:
    """The pieces of every document: ids of the text and ``end``, cut into ``limit`` tokens where longer.

    ``slim`` has ``doc_id`` and ``text``; a null text is empty and gives one piece of one token.
    """
    def cut(batches):
        free_memory()
        encode = WordEncoder(tokenizer, end)
        for batch in batches:
            rows, out = [], []
            for i, ids in enumerate(encode.all(batch["text"])):
                ids = ids.astype("<u4", copy=False)
                for start in range(0, len(ids), limit):
                    raw = ids[start : start + limit].tobytes()
                    rows.append(i)
                    out.append((start // limit, start, len(raw) // 4, zlib.crc32(raw)))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), KINDS)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(rows)), *columns],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def placed(cut: DataFrame, pack: Callable[[dict[int, int]], list[Run]], cells: int = CELLS) -> DataFrame:
    """``sequence_id`` and ``offset`` for stored pieces, as ``pack`` decides from the counts of lengths.

    The driver sees at most lengths times ``cells`` counts. No length is ranked in one task: ranks
    are counted within cells of a hash and moved on by the number in the cells before.
    """
    cell = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)).cast("int")
    dealt = cut.withColumn("cell", cell)
    counts = sorted(tuple(r) for r in dealt.groupBy("length", "cell").count().collect())
    before, total = [], {}
    for length, c, n in counts:
        before.append((length, c, total.get(length, 0)))
        total[length] = total.get(length, 0) + n
    spark = cut.sparkSession
    base = spark.createDataFrame(before, "length long, cell int, base long")
    runs = spark.createDataFrame(
        [(r.length, r.first, r.first + r.number, r.sequence, r.offset) for r in pack(total)],
        "length long, first long, beyond long, sequence long, offset long",
    )
    order = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(order) - 1)
        .join(F.broadcast(base), ["length", "cell"])
        .withColumn("rank", F.col("rank") + F.col("base"))
    )
    own = (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    return ranked.alias("p").join(F.broadcast(runs).alias("r"), own).select(
        *(F.col(f"p.{c}").alias(c) for c in cut.columns),
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("offset"),
    )


def stored_pieces(slim: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    return stored(pieces(slim, tokenizer, limit), "pieces")
