"""Files that arrive one after the other: survivors, silver, gold and coverage kept up by parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import SUBSTRING_TAGS
from ..functions.text import with_text
from ..operators.catalogue import KEY, PRODUCT_COLUMNS, live_products, product_columns, with_description
from ..operators.report import coverage_counts, coverage_rows
from ..operators.survivors import follow_parts, kept_counts, merge_additions
from ..sources.pieces import PIECE
from .regex_gold import regex_gold


def add_to_catalogue(
    raw: DataFrame, survivors: str, parts: int, order: Sequence[str] | None = None
) -> DataFrame:
    """Merge raw rows into the kept survivors; returns the keys of products whose row is new.

    Survivors without a description are kept as well: as in ``catalogue.silver`` they are left out
    after deduplication, and hold their place against rows that come later in ``order``.
    """
    order = list(order or [])
    extra = [c for c in order if c not in PRODUCT_COLUMNS]
    return merge_additions(product_columns(live_products(raw), extra), survivors, parts, KEY, order or None)


def _silver(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return with_text(with_description(product_columns(rows, extra)))


def silver_of(spark: SparkSession, survivors: str) -> DataFrame:
    """The silver table of everything that arrived; no shuffle, one scan of the survivors."""
    return _silver(spark.table(survivors))


def tag_additions(spark: SparkSession, survivors: str, gold: str) -> DataFrame:
    """Write the gold rows and tag counts of the parts that changed; returns (piece, part) of these."""
    return follow_parts(
        spark, survivors, gold, lambda rows: regex_gold(_silver(rows, [PIECE])), coverage_counts(list(SUBSTRING_TAGS))
    )


def kept_coverage(spark: SparkSession, gold: str) -> DataFrame:
    """The coverage report from the counts kept per part; no product is read."""
    return coverage_rows(kept_counts(spark, gold), list(SUBSTRING_TAGS))
