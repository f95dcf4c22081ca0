"""A table of one row per key that additions are merged into, and tables that follow it part by part.

The survivor of a key is the smallest of its rows in a fixed order, so survivors of parts of the
input merge to the survivor of all of it: a row that arrives later only has to be compared with the
one that stands. The rows lie in pieces by the hash of the key (see ``sources.pieces``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import pieces
from ..sources.pieces import PIECE
from ..sources.shared import stored
from .catalogue import KEY, deduplicate, survivor_order

PART = "part"


def _same_key(rows: DataFrame, others: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join by a key that may be NULL, which is one key as in ``deduplicate``."""
    keys = others.select(F.col(key).alias("_key"))
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_key")), how)


def new_survivors(
    additions: DataFrame, held: DataFrame, key: str = KEY, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Rows of ``additions`` that survive against those ``held``, which have one row per key.

    At most one row per key and task is shuffled, also where a key holds a large share of the
    additions, and of the held rows those with a key that was added. Of equal rows the held one stays.
    """
    order = list(order) if order is not None else survivor_order(additions.columns, key)
    arrived = deduplicate(additions, key, order)
    rivals = _same_key(held.select(*additions.columns), arrived, key, "left_semi")
    both = arrived.withColumn("_new", F.lit(True)).unionByName(rivals.withColumn("_new", F.lit(False)))
    return deduplicate(both, key, [*order, "_new"]).filter("_new").drop("_new")


def merge_additions(
    additions: DataFrame, name: str, parts: int, key: str = KEY, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Merge rows into the survivors kept as ``name``; returns (key) for the survivors that are new.

    The table is the one that ``deduplicate`` would make of all rows that ever arrived, in any order
    of arrival and however often they came, if ``order`` ranks no two different rows of a key alike;
    the default order does not. Parts, by hash of the key, in which no row survives are not written,
    and parts without an addition are not read. Choose so many parts that an addition touches few.
    A failed merge leaves the table as it was. Columns and number of parts stay those of the first call.
    """
    spark = additions.sparkSession
    pieces.tidy(spark, name)
    listed = pieces.pieces(spark, name)
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    base = pieces.next_piece(spark, name)
    columns = additions.columns
    if listed is None:
        pieces.add_rows(deduplicate(additions, key, order).withColumn(PIECE, part + base), name)
        numbers = F.col("id").cast("int")
        every = spark.range(parts).select((numbers + base).alias(PIECE), numbers.alias(PART))
        return pieces.publish(every, name, columns).select(key)
    there = spark.table(name).columns
    if sorted(there) != sorted(columns) or listed.count() != parts:
        raise ValueError(f"{name} has the columns {there} and {listed.count()} parts")
    additions = stored(deduplicate(additions, key, order), "additions")
    asked = listed.join(additions.select(part.alias(PART)).distinct(), PART)
    new = stored(new_survivors(additions, pieces.rows_in(spark, name, asked), key, order), "survivors-new")
    if new.isEmpty():
        return new.select(key)
    touched = stored(new.select(part.alias(PART)).distinct(), "survivors-parts")
    held = pieces.rows_in(spark, name, listed.join(touched, PART)).select(*columns)
    rows = _same_key(held, new, key, "left_anti").unionByName(new)
    pieces.add_rows(rows.withColumn(PIECE, part + base), name)
    renewed = touched.select((F.col(PART) + base).alias(PIECE), PART)
    kept = listed.join(touched, PART, "left_anti").select(PIECE, PART)
    pieces.publish(kept.unionByName(renewed), name, columns)
    pieces.tidy(spark, name)
    return new.select(key)


def follow_parts(
    spark: SparkSession,
    source: str,
    name: str,
    make: Callable[[DataFrame], DataFrame],
    counts: Sequence[Column] = (),
) -> DataFrame:
    """Bring ``name`` up to date with a table kept in parts; returns (piece, part) of the parts renewed.

    ``make`` turns rows into rows and keeps the column ``piece``. A piece of the source is never
    written again, so pieces that the list of ``name`` has are neither read nor made again, and what
    is missing after a failed run is made by the next. ``counts`` are aggregates that add up over
    parts; those of a part are kept in the list, so their totals need no rows (``kept_counts``).
    """
    pieces.tidy(spark, name)
    present = pieces.pieces(spark, source).select(PIECE, PART)
    known = pieces.pieces(spark, name)
    missing = present if known is None else present.join(known, PIECE, "left_anti")
    new = stored(missing.select(PIECE, PART), "parts-new")
    if known is not None and new.isEmpty():
        return new
    rows = make(pieces.rows_in(spark, source, new))
    columns = [c for c in rows.columns if c != PIECE]
    if known is not None and columns != spark.table(name).columns:
        raise ValueError(f"{name} has the columns {spark.table(name).columns}")
    pieces.add_rows(rows, name)
    listed = new
    if counts:
        counted = pieces.rows_in(spark, name, new).groupBy(PIECE).agg(*counts)
        listed = new.join(counted, PIECE, "left").na.fill(0)
    if known is not None:
        if sorted(known.columns) != sorted(listed.columns):
            raise ValueError(f"{name} keeps {known.columns}")
        listed = known.join(present, PIECE, "left_semi").unionByName(listed)
    pieces.publish(listed, name, columns)
    pieces.tidy(spark, name)
    return new


def kept_counts(spark: SparkSession, name: str) -> DataFrame:
    """Totals of the counts kept per part, in one row; only the list of parts is read."""
    listed = pieces.pieces(spark, name).drop(PIECE, PART)
    return listed.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in listed.columns))
