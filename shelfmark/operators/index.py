"""Keeping an embedding table in step with its source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import pieces
from ..sources.shared import stored
from ..sources.tables import write_table
from .catalogue import KEY, deduplicate
from .embedding import Embedder, with_embedding

TEXT = "concatenated_text"


def indexable(df: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """The rows an index holds: key and text both present."""
    return df.filter(F.col(key).isNotNull() & F.col(text).isNotNull())


def fingerprints(source: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One (key, text_hash) row per key.

    The grouping merges copies of a key before the shuffle, so the join after
    it has one row per key on this side however often a key is repeated.
    """
    hashed = indexable(source, key, text).select(key, F.xxhash64(text).alias("text_hash"))
    return hashed.groupBy(key).agg(F.max("text_hash").alias("text_hash"))


def index_changes(
    source: DataFrame, index: DataFrame, key: str = KEY, text: str = TEXT
) -> DataFrame:
    """What must happen to the index: (key, change, text_hash), unchanged keys left out.

    Only keys and 8-byte hashes are shuffled and joined. A text that turned
    NULL is a delete.
    """
    new = fingerprints(source, key, text)
    old = index.select(key, F.col("text_hash").alias("_old"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("text_hash").isNull(), "delete")
        .when(F.col("text_hash") != F.col("_old"), "update")
    )
    both = new.join(old, key, "full_outer").select(key, change.alias("change"), "text_hash")
    return both.filter(F.col("change").isNotNull())


def embedded(
    source: DataFrame,
    make_embedder: Callable[[], Embedder],
    key: str = KEY,
    text: str = TEXT,
    partitions: int | None = None,
) -> DataFrame:
    """Index rows (key, text_hash, embedding) for source rows that are unique by key.

    ``partitions`` sets how many embedders run at a time; leave it out to keep
    the input's partitions and save the shuffle.
    """
    rows = indexable(source, key, text).select(key, F.xxhash64(text).alias("text_hash"), text)
    if partitions is not None:
        rows = rows.repartition(partitions)
    return with_embedding(rows, make_embedder, text).select(key, "text_hash", "embedding")


def one_per_key(source: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """(key, text) of the row that ``fingerprints`` stands for; a task sends one row per key at most."""
    rows = indexable(source, key, text).select(key, text)
    return deduplicate(rows, key, [F.xxhash64(text).desc()])


def refreshed(
    source: DataFrame,
    index: DataFrame,
    changes: DataFrame,
    make_embedder: Callable[[], Embedder],
    key: str = KEY,
    text: str = TEXT,
    partitions: int | None = None,
) -> DataFrame:
    """The index after the changes; only new and changed texts are embedded, once, and stored.

    A row leaves the index only if its key is deleted or its new vector is
    there: a source that has changed again since the diff costs no key, and the
    next sync brings it up to date.
    """
    fresh, gone = _fresh_and_gone(source, changes, make_embedder, key, text, partitions)
    kept = index.join(gone, key, "left_anti")
    return kept.select(key, "text_hash", "embedding").unionByName(fresh)


def _fresh_and_gone(
    source: DataFrame, changes: DataFrame, make_embedder: Callable[[], Embedder], key: str, text: str,
    partitions: int | None,
) -> tuple[DataFrame, DataFrame]:
    """Index rows of new and changed texts, stored, and the keys whose rows leave the index."""
    wanted = changes.filter(F.col("change") != "delete").select(
        F.col(key).alias("_key"), F.col("text_hash").alias("_hash")
    )
    # Written as no plain equality, the hash test is not a join key: the join
    # stays on the key alone, which the deduplication has laid the rows out by.
    same_text = F.xxhash64(text).bitwiseXOR(F.col("_hash")) == 0
    once = one_per_key(source, key, text)
    changed = once.join(wanted, (F.col(key) == F.col("_key")) & same_text).select(key, text)
    fresh = stored(embedded(changed, make_embedder, key, text, partitions), "index-fresh")
    return fresh, changes.filter(F.col("change") == "delete").select(key).union(fresh.select(key))


def sync_index(
    source: DataFrame,
    name: str,
    make_embedder: Callable[[], Embedder],
    key: str = KEY,
    text: str = TEXT,
    buckets: int | None = None,
    partitions: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Bring the index table ``name`` in step with the source, creating it if absent.

    Returns the changes made. They are written to the shared folder first, as
    the refresh reads them twice; the new index is a new version of the table.
    With ``buckets`` the index is laid out by key, and the diff of a source
    bucketed alike needs no shuffle. With ``parts`` a sync writes only those
    parts, by hash of the key, that hold a change: choose so many that a sync's
    changes meet few of them. The number stands once the index is there.
    """
    if parts is not None:
        if buckets is not None:
            raise ValueError("an index has buckets or parts")
        return _sync_parts(source, name, make_embedder, key, text, parts, partitions)
    spark = source.sparkSession
    bucket_by = (buckets, key) if buckets else None
    if not spark.catalog.tableExists(name):
        rows = embedded(one_per_key(source, key, text), make_embedder, key, text, partitions)
        index = write_table(rows, name, bucket_by=bucket_by)
        return index.select(key, F.lit("insert").alias("change"))
    index = spark.table(name)
    changes = stored(index_changes(source, index, key, text), "index-changes")
    write_table(
        refreshed(source, index, changes, make_embedder, key, text, partitions), name, bucket_by=bucket_by
    )
    return changes.select(key, "change")


def _sync_parts(
    source: DataFrame, name: str, make_embedder: Callable[[], Embedder], key: str, text: str, parts: int,
    partitions: int | None,
) -> DataFrame:
    """A sync that reads and writes the rows of touched parts only; see ``pieces``."""
    spark = source.sparkSession
    pieces.tidy(spark, name)
    listed = pieces.pieces(spark, name)
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    columns = [key, "text_hash", "embedding"]
    if listed is None:
        rows = embedded(one_per_key(source, key, text), make_embedder, key, text, partitions)
        pieces.add_rows(rows.withColumn(pieces.PIECE, part), name)
        every = spark.range(parts).select(F.col("id").cast("int").alias(pieces.PIECE), F.col("id").cast("int").alias("part"))
        index = pieces.publish(every, name, columns)
        return index.select(key, F.lit("insert").alias("change"))
    there = listed.count()
    if there != parts:
        raise ValueError(f"the index {name} has {there} parts")
    changes = stored(index_changes(source, pieces.rows_in(spark, name), key, text), "index-changes")
    if changes.isEmpty():
        return changes.select(key, "change")
    touched = stored(changes.select(part.alias("part")).distinct(), "index-parts")
    fresh, gone = _fresh_and_gone(source, changes, make_embedder, key, text, partitions)
    held = pieces.rows_in(spark, name, listed.join(touched, "part"))
    rows = held.join(gone, key, "left_anti").select(*columns).unionByName(fresh)
    base = pieces.next_piece(spark, name)
    pieces.add_rows(rows.withColumn(pieces.PIECE, part + base), name)
    renewed = touched.select((F.col("part") + base).alias(pieces.PIECE), "part")
    pieces.publish(listed.join(touched, "part", "left_anti").select(pieces.PIECE, "part").unionByName(renewed), name, columns)
    pieces.tidy(spark, name)
    return changes.select(key, "change")
