"""Filters on tags and the tag coverage report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_any(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Rows where at least one tag column has its wanted value."""
    tests: list[Column] = [F.col(tag) == value for tag, value in wanted.items()]
    return df.filter(reduce(lambda a, b: a | b, tests))


def containing(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """The one text column, for rows that match a case-insensitive LIKE pattern."""
    return df.select(text).filter(F.col(text).ilike(pattern))


def tag_coverage(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Per tag column, how many rows carry a tag and how many carry ''; NULL is in neither.

    All counts come from one aggregate over one scan; only its single row is
    turned into one row per column, so the input is never multiplied.
    """
    return coverage_rows(df.agg(*coverage_counts(tags)), tags)


def coverage_counts(tags: Sequence[str]) -> list[Column]:
    """Aggregates that count tagged and untagged rows of each tag column; they add up over parts."""
    return [
        *(F.count_if(F.col(tag) != "").alias(f"{tag}_tagged") for tag in tags),
        *(F.count_if(F.col(tag) == "").alias(f"{tag}_untagged") for tag in tags),
    ]


def coverage_rows(counts: DataFrame, tags: Sequence[str]) -> DataFrame:
    """The one row of counts as a row per tag column."""
    rows = F.array(
        *(
            F.struct(
                F.lit(tag).alias("category"),
                F.col(f"{tag}_tagged").alias("tagged"),
                F.col(f"{tag}_untagged").alias("untagged"),
            )
            for tag in tags
        )
    )
    return counts.select(F.inline(rows))
