"""From parsed model output to values and flag columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.json_text import any_key_contains, with_repaired_json, with_tag_map
from ..sources.shared import stored


def with_parsed_tags(
    df: DataFrame,
    answer: str = "tagged_description",
    out: str = "cleaned_tagged_description",
) -> DataFrame:
    """Repair the model's answer and parse it to category -> values."""
    return with_tag_map(with_repaired_json(df, answer, out), out, out)


def map_entries(df: DataFrame, tags: str, keep: Sequence[str] = ()) -> DataFrame:
    """One (Key, Values) row per category; none for a NULL or empty map.

    A plain explode makes the optimizer add a test on the map and push it below
    the parsing, which would parse each text again for it.
    """
    rows = df.select(*keep, F.explode_outer(tags).alias("Key", "Values"))
    return rows.filter(F.col("Key").isNotNull())


def entry_values(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One (Key, Value) row per value of a category."""
    return df.select(*keep, "Key", F.explode("Values").alias("Value"))


def distinct_values(df: DataFrame, tags: str) -> DataFrame:
    """All distinct non-NULL values of all categories.

    Values repeat within a row far less than between rows; the distinct's
    partial step drops both kinds before the shuffle.
    """
    values = entry_values(map_entries(df, tags)).select("Value")
    return values.filter(F.col("Value").isNotNull()).distinct()


def value_numbers(df: DataFrame, tags: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number): a number for every distinct value, the same as in ``known`` for those it has.

    New values are numbered in their order after all known ones, without gaps: each task numbers a
    range of them, after a count per task. No value passes the driver.
    """
    found = distinct_values(df, tags).select(F.col("Value").alias("value"))
    if known is not None:
        known = stored(known.select("value", "number"), "values-known")
        found = found.join(known, "value", "left_anti")
    ranged = found.repartitionByRange("value").withColumn("_task", F.spark_partition_id())
    new = stored(ranged, "values-new")
    sizes = new.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    # One row for each task.
    first = sizes.select("_task", (F.sum("_size").over(Window.orderBy("_task")) - F.col("_size")).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_task").orderBy("value")) - 1
    numbered = new.join(first, "_task").select("value", (F.col("_first") + place).alias("number"))
    if known is None:
        return numbered
    highest = known.agg(F.max("number")).first()[0]
    base = 0 if highest is None else highest + 1
    return known.unionByName(numbered.withColumn("number", F.col("number") + base))


def with_flag_numbers(
    df: DataFrame, numbers: DataFrame, tags: str, key: str, keys: Sequence[str] = tuple(rules.FLAG_KEYS),
    out: str = "flag_numbers",
) -> DataFrame:
    """(key, ``out``): the numbers of the values set in the lists of ``keys``, sorted, for every distinct key.

    A row has as many entries as values, however many values there are in all. A key without a value
    has an empty list.
    """
    lists = F.array(*(F.coalesce(F.col(tags).getItem(k), F.array()) for k in keys))
    values = df.select(key, F.explode_outer(F.array_distinct(F.flatten(lists))).alias("value"))
    found = values.join(numbers.select("value", "number"), "value", "left")
    # Numbers are merged on the map side, and a null is no number.
    return found.groupBy(key).agg(F.sort_array(F.collect_set("number")).alias(out))


def collect_values(df: DataFrame, tags: str, most: int | None = None) -> list[str]:
    """The distinct values, sorted, for flag columns; refuses more than ``most``, if given.

    Columns have to be named on the driver. For values without a bound, ``flag_rows`` needs no such list.
    """
    found = distinct_values(df, tags)
    rows = (found if most is None else found.limit(most + 1)).collect()
    if most is not None and len(rows) > most:
        raise ValueError(f"more than {most} distinct tag values: use flag_rows for these")
    return sorted(row["Value"] for row in rows)


def flag_column(value: str) -> str:
    return "flag_" + value.replace(" ", "_")


def with_value_flags(
    df: DataFrame,
    tags: str,
    values: Sequence[str],
    keys: Sequence[str] = tuple(rules.FLAG_KEYS),
) -> DataFrame:
    """One nullable 0/1 column per value, tested against the lists of ``keys``.

    Values whose column names differ only in case share a column that is set
    if any of them is present. A column of the same name is replaced.
    """
    groups: dict[str, list[str]] = {}
    for value in sorted(values):
        groups.setdefault(flag_column(value).lower(), []).append(value)
    flags = [
        any_key_contains(F.col(tags), keys, group).cast("int").alias(flag_column(group[0]))
        for group in groups.values()
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in groups]
    return df.select(*kept, *flags)


def flag_rows(
    df: DataFrame, tags: str, key: str, keys: Sequence[str] = tuple(rules.FLAG_KEYS)
) -> DataFrame:
    """The set flags as rows (key, flag), for value sets too large for columns."""
    lists = F.array(*(F.coalesce(F.col(tags).getItem(k), F.array()) for k in keys))
    return (
        df.select(key, F.explode(F.array_distinct(F.flatten(lists))).alias("value"))
        .filter(F.col("value").isNotNull())
        .select(key, F.concat(F.lit("flag_"), F.replace("value", F.lit(" "), F.lit("_"))).alias("flag"))
    )


def first_rows(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order``; all rows if ``n`` is None.

    Sort and limit plan as one top-n per partition, merged, not as a full sort.
    """
    return df if n is None else df.orderBy(*order).limit(n)
