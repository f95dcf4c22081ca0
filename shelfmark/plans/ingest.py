"""Catalogue file to silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalogue import KEY, silver
from ..sources.files import read_catalogue
from ..sources.tables import write_table


def ingest(
    spark: SparkSession,
    path: str,
    table: str,
    order: Sequence[str] | None = None,
    buckets: int | None = None,
    **csv_options,
) -> DataFrame:
    """Read, filter, deduplicate and join the text; returns the silver table.

    ``buckets`` lays the table out by product, for index syncs without a shuffle.
    """
    frame = silver(read_catalogue(spark, path, **csv_options), order)
    return write_table(frame, table, bucket_by=(buckets, KEY) if buckets else None)
