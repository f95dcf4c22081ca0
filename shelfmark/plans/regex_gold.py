"""Silver table to regex gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import SUBSTRING_TAGS
from ..functions.tags import with_flags, with_substring_tags
from ..functions.text import with_clean_text
from ..operators.catalogue import KEY
from ..operators.report import tag_coverage
from ..sources.tables import read_table, write_table


def regex_gold(silver: DataFrame) -> DataFrame:
    """Cleaned text, seven tags and the flags. No shuffle: one scan, one write."""
    return with_flags(with_substring_tags(with_clean_text(silver)))


def tag_catalogue(
    spark: SparkSession, silver_table: str, gold_table: str, buckets: int | None = None
) -> DataFrame:
    """Write the gold table, keeping columns that only an earlier version has.

    ``buckets`` lays it out by product, so that looking up a few products, as a
    search does for its matches, reads a few buckets. It costs a shuffle.
    """
    gold = regex_gold(read_table(spark, silver_table))
    return write_table(gold, gold_table, merge_schema=True, bucket_by=(buckets, KEY) if buckets else None)


def coverage(gold: DataFrame) -> DataFrame:
    return tag_coverage(gold, list(SUBSTRING_TAGS))
