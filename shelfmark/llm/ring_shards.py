"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, DataFrame functions only."""

from __future__ import annotations

from collections import deque
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import column

SHARDS = 40
POINTS = 128  # virtual nodes of a shard
CELLS = 1 << 16  # places on the ring; keys of one place are taken in the order of their hash
OVERHEAD = 16


class Part(NamedTuple):
    """Keys ``first`` to ``beyond - 1`` of a place, in the slots of a shard from ``slot`` on."""

    cell: int
    first: int
    beyond: int
    shard: int
    slot: int


def ring(spark: SparkSession, shards: int, points: int, cells: int) -> list[tuple[int, int]]:
    """Place and shard of every virtual node, clockwise. More shards add nodes and move none."""
    shard, point = F.expr(f"id div {points}"), F.col("id") % points
    place = F.pmod(F.xxhash64(shard, point, F.lit("virtual node")), F.lit(cells))
    nodes = spark.range(shards * points).select(place.alias("cell"), shard.cast("int").alias("shard"))
    return sorted((r.cell, r.shard) for r in nodes.collect())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take: with no slack exactly as many as there are, at most one apart."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def sweep(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[Part]:
    """Walk the ring clockwise; each node takes what lies before it, then what full nodes passed on.

    Keys that find a shard full go on to the next node, round the ring if need be.
    """
    room, used = list(room), [0] * len(room)
    waiting: deque[tuple[int, int, int]] = deque()
    parts: list[Part] = []

    def take(shard: int, queue: deque) -> None:
        while queue and room[shard]:
            cell, a, b = queue.popleft()
            n = min(b - a, room[shard])
            parts.append(Part(cell, a, a + n, shard, used[shard]))
            used[shard] += n
            room[shard] -= n
            if a + n < b:
                queue.appendleft((cell, a + n, b))

    cells = deque(sorted(counts.items()))
    for lap in range(2):
        for place, shard in nodes:
            own: deque = deque()
            while cells and (cells[0][0] <= place or lap):
                cell, n = cells.popleft()
                own.append((cell, 0, n))
            take(shard, own)
            take(shard, waiting)
            waiting.extend(own)
    # Keys beyond the last node met the first one in the second lap; what waits still goes round.
    while waiting:
        for _, shard in nodes:
            take(shard, waiting)
    return parts


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    points: int = POINTS,
    cells: int = CELLS,
    slack: float = 0.0,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row.

    A row's key is a hash of its id and text. Without ``slack`` all shards hold equally many rows,
    at most one apart; with it a shard takes up to (1 + slack) times its share, and fewer rows move
    when a shard is added. Slots of a shard run from 0 without gaps. ``size``: UTF-8 bytes and 16
    more. A null text is empty; a null id is an id like any other. Repeated rows are counted before
    they are shuffled and get a slot each. An empty table gives no rows.

    The driver sees the number of rows in each of ``cells`` places, never a key.
    """
    spark = docs.sparkSession
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    keyed = docs.select(
        column(doc_id).alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(column(doc_id).cast("string"), body).alias("key"),
    )
    rows = stored(keyed.groupBy(*keyed.columns).agg(F.count("*").alias("copies")), "ring")
    placed = rows.withColumn("cell", F.pmod("key", F.lit(cells)))
    counts = {r.cell: r.n for r in placed.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}
    room = capacities(sum(counts.values()), shards, slack)
    parts = spark.createDataFrame(
        sweep(counts, ring(spark, shards, points, cells), room),
        "cell long, first long, beyond long, shard int, slot long",
    )
    order = Window.partitionBy("cell").orderBy("key", "doc_id", "size", "text_crc32")
    upto = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = (
        placed.withColumn("start", upto - F.col("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("rank", F.col("start") + F.col("copy"))
    )
    own = (F.col("k.cell") == F.col("p.cell")) & F.col("rank").between(F.col("first"), F.col("beyond") - 1)
    # At most one part for each place and two more for each virtual node: of a proven size.
    return each.alias("k").join(F.broadcast(parts.alias("p")), own).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"),
    )
