"""Changes between versions of a source, and several of them in a row as one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalogue import KEY
from .index import TEXT, fingerprints


def _change(old: Column, new: Column) -> Column:
    """What turns one hash into the other; NULL, no change, where they are the same."""
    return (
        F.when(old.isNull() & new.isNotNull(), "insert")
        .when(old.isNotNull() & new.isNull(), "delete")
        .when(old != new, "update")
    )


def change_set(before: DataFrame, after: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """(key, change, old_hash, text_hash) between two versions, one row per changed key.

    Rows without a key or a text are not there; of several texts of a key the one that the index
    would hold counts. Keys and hashes alone are shuffled.
    """
    old = fingerprints(before, key, text).withColumnRenamed("text_hash", "old_hash")
    both = fingerprints(after, key, text).join(old, key, "full_outer")
    return _changed(both, key)


def _changed(both: DataFrame, key: str) -> DataFrame:
    change = _change(F.col("old_hash"), F.col("text_hash")).alias("change")
    return both.select(key, change, "old_hash", "text_hash").filter(F.col("change").isNotNull())


def composed(changes: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """The change sets of successive versions, earliest first, as the one from first to last.

    An insert and a delete of a key are none, two updates are one, and a text that comes back is no
    change. One aggregate: a task sends at most one row per key, and the sources are not read.
    """
    steps = _in_steps(changes, key)
    ends = steps.groupBy(key).agg(
        F.min(F.struct("step", "old_hash")).alias("first"), F.max(F.struct("step", "text_hash")).alias("last")
    )
    return _changed(ends.select(key, F.col("first.old_hash"), F.col("last.text_hash")), key)


def _in_steps(changes: Sequence[DataFrame], key: str) -> DataFrame:
    if not changes:
        raise ValueError("no change sets to compose")
    parts = [c.select(key, F.lit(i).alias("step"), "old_hash", "text_hash") for i, c in enumerate(changes)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def misfits(changes: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Keys of which a change set does not begin where the one before it ended: a version is missing.

    A key has at most one row per change set, so its list is as long as ``changes`` at most.
    """
    row = F.struct("step", "old_hash", "text_hash")
    rows = _in_steps(changes, key).groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    pairs = F.arrays_zip(
        F.slice("rows", 1, F.size("rows") - 1).alias("a"), F.slice("rows", 2, F.size("rows")).alias("b")
    )
    broken = F.exists(pairs, lambda p: ~p["a"]["text_hash"].eqNullSafe(p["b"]["old_hash"]))
    return rows.filter(broken).select(key)


def applied(state: DataFrame, changes: DataFrame, key: str = KEY) -> DataFrame:
    """(key, text_hash) of a version, given those of the version before and the changes since."""
    new = changes.select(key, F.col("text_hash").alias("_new"), F.lit(True).alias("_changed"))
    both = state.select(key, "text_hash").join(new, key, "full_outer")
    after = F.when(F.col("_changed"), F.col("_new")).otherwise(F.col("text_hash"))
    return both.select(key, after.alias("text_hash")).filter(F.col("text_hash").isNotNull())
