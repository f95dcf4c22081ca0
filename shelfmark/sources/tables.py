"""Catalog tables, schemas and views."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def use_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema if it is missing and make it the current one."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a frame read straight from files at least one partition per core.

    For work that is heavy per row on input in few pieces: small files, or
    large ones that cannot be split. Input in enough pieces is left as it is,
    without a shuffle. Rows go by ``keys``, which should be close to unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def merged_with(df: DataFrame, name: str) -> DataFrame:
    """The frame in the schema of the table plus its own new columns.

    Columns only the table has are NULL. A column with another type is refused.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return df
    new = {field.name.lower(): field for field in df.schema}
    columns = []
    for old in spark.table(name).schema:
        field = new.pop(old.name.lower(), None)
        if field is None:
            columns.append(F.lit(None).cast(old.dataType).alias(old.name))
        elif field.dataType != old.dataType:
            raise ValueError(f"column {old.name}: {field.dataType} does not fit {old.dataType}")
        else:
            columns.append(F.col(f"`{field.name}`").alias(old.name))
    return df.select(*columns, *(F.col(f"`{field.name}`") for field in new.values()))


def write_table(
    df: DataFrame,
    name: str,
    merge_schema: bool = False,
    bucket_by: tuple[int, str] | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    keep: int = 2,
    partition_by: str | None = None,
) -> DataFrame:
    """Write a new version of a table, point the view ``name`` at it and return it.

    The new version may be computed from the present one. Readers see either
    version whole, and a failed write leaves the present one in place. The
    switch touches the catalog only; no data is copied. All but the newest
    ``keep`` versions are dropped. A plain table of that name is replaced once
    the new version stands.

    ``bucket_by`` (number, column) lays the rows out so that later joins and
    groupings on that column need no shuffle. Give it a column with few rows
    per value, such as a key: each bucket is written by one task as one file.
    With ``path`` each version has a folder of its own below it. ``partition_by``
    lays a version out by the values of a column.
    """
    spark = df.sparkSession
    if merge_schema:
        df = merged_with(df, name)
    versions = _versions(spark, name)
    number = 1 + (versions[-1][0] if versions else 0)
    version = f"{name}__v{number:06d}_{uuid4().hex[:8]}"
    if bucket_by is not None:
        df = df.repartition(*bucket_by)
    writer = df.write.format(fmt)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/{version.rpartition('.')[2]}")
    writer.saveAsTable(version)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {_quoted(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(version)}")
    for _, old in versions[: max(0, len(versions) + 1 - keep)]:
        spark.sql(f"DROP TABLE {_quoted(old)}")
    return spark.table(name)


def bucketed_by(spark: SparkSession, name: str) -> tuple[int, str] | None:
    """Number of buckets and column of a table, or the version behind a view, bucketed by one column."""
    name = newest_version(spark, name) or name
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()}
    columns = about.get("Bucket Columns", "").strip("[]").replace("`", "").split(", ")
    if "Num Buckets" not in about or len(columns) != 1:
        return None
    return int(about["Num Buckets"]), columns[0]


def newest_version(spark: SparkSession, name: str) -> str | None:
    """The table behind the view of a written table."""
    versions = _versions(spark, name)
    return versions[-1][1] if versions else None


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _versions(spark: SparkSession, name: str) -> list[tuple[int, str]]:
    """Number and full name of the versions of a written table, oldest first."""
    prefix, _, base = name.rpartition(".")
    place = f" IN {_quoted(prefix)}" if prefix else ""
    found = []
    for row in spark.sql(f"SHOW TABLES{place} LIKE '{base.lower()}__v*'").collect():
        table = row["tableName"]
        number = table[len(base) + 3 :].split("_")[0]
        if number.isdigit():
            found.append((int(number), f"{prefix}.{table}" if prefix else table))
    return sorted(found)
