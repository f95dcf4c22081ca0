"""The raw catalogue file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.catalogue import PRODUCT_COLUMNS, STATUS

REQUIRED = [STATUS, *PRODUCT_COLUMNS]


def read_catalogue(
    spark: SparkSession, path: str | list[str], multiline: bool = False, escape: str = "\\"
) -> DataFrame:
    """Read a CSV catalogue with a header row; every column is a nullable string.

    The header of the first file names the columns. All files are then read
    with that schema, and a file whose header differs is refused instead of
    being read into the wrong columns. ``multiline`` allows line breaks inside
    quotes, at the price that a file is no longer split between tasks.
    """
    reader = spark.read.options(header=True, multiLine=multiline, escape=escape)
    names = reader.csv(path).columns
    missing = [c for c in REQUIRED if c not in names]
    if missing:
        raise ValueError(f"catalogue lacks the columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    return reader.option("enforceSchema", False).schema(schema).csv(path)
