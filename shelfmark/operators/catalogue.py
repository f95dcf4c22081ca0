"""Catalogue rows: live filter, projection, deduplication, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TEXT_PARTS, with_text

# Fixed values.
KEY = "site_product_identifier"
DESCRIPTION = "product_description"
STATUS = "availability_status"
RETIRED = "R_RETIRED"
PRODUCT_COLUMNS = TEXT_PARTS


def is_live() -> Column:
    return F.col(STATUS) != RETIRED


def live_products(df: DataFrame) -> DataFrame:
    """Drop retired products; an unknown (NULL) status is dropped too."""
    return df.filter(is_live())


def status_counts(df: DataFrame) -> DataFrame:
    """Rows before and after the live filter, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("original_count"), F.count_if(is_live()).alias("filtered_count")
    )


def product_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*PRODUCT_COLUMNS, *extra)


def survivor_order(columns: Sequence[str], key: str = KEY) -> list[Column]:
    """Order by which one row per key stays: a hash of the other columns, then these themselves.

    The hash decides nearly always; the columns are compared where two rows share it.
    """
    others = [c for c in columns if c != key]
    return [F.xxhash64(*others), *(F.col(c).asc_nulls_last() for c in others)] if others else []


def deduplicate(
    df: DataFrame, key: str = KEY, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep one row per key: the first in ``order``, by default by a hash of the other columns.

    NULL keys count as one key. A fixed survivor gives the same table when a
    lost executor's tasks are run again. Each map task keeps at most one row
    per key before the shuffle (WindowGroupLimit), so a key that holds a large
    share of the rows sends a few rows only.
    """
    if order is None:
        order = survivor_order(df.columns, key)
    first = Window.partitionBy(key).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def with_description(df: DataFrame) -> DataFrame:
    return df.filter(F.col(DESCRIPTION).isNotNull())


def silver(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Raw catalogue to the silver table: live, one row per product, with text.

    The description filter stays after deduplication: a product whose surviving
    row has no description is left out.
    """
    order = list(order or [])
    extra = [c for c in order if c not in PRODUCT_COLUMNS]
    live = product_columns(live_products(df), extra)
    return with_text(with_description(deduplicate(live, order=order or None)).drop(*extra))
