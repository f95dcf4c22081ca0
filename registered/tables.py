"""Sources and sinks: the catalogue through files, tables, schemas and views."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.catalogue import silver
from shelfmark.plans.regex_gold import regex_gold
from shelfmark.sources.files import read_catalogue
from shelfmark.sources.shared import fresh_path
from shelfmark.sources.tables import read_table, register_view, use_schema, write_table

from .inputs import PRODUCT, raw_catalogue, silver_catalogue, with_steps
from .catalogue import SUBSTRING_SQL, _flags_sql


def _table(spark: SparkSession, df: DataFrame, label: str) -> str:
    """Write a table of its own name and place, so that runs do not meet."""
    name = f"{label}_{uuid4().hex}"
    write_table(df, name, path=fresh_path(spark, label))
    return name


def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "catalogue-csv")
    raw_catalogue(spark, folder).write.csv(path, header=True)
    return read_catalogue(spark, path)


def csv_silver(spark, folder):
    path = fresh_path(spark, "catalogue-csv")
    raw = raw_catalogue(spark, folder).withColumn(
        "p_partkey", F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    )
    raw.write.csv(path, header=True)
    return silver(read_catalogue(spark, path), order=["p_partkey"])


def table_roundtrip(spark, folder):
    return read_table(spark, _table(spark, silver_catalogue(spark, folder), "silver"))


def schema_evolution(spark, folder):
    """An earlier gold table with a column of its own, overwritten by a new one."""
    gold = regex_gold(silver_catalogue(spark, folder))
    earlier = gold.select(
        "site_product_identifier", "age_range", F.length("product_name").alias("name_length")
    )
    name = _table(spark, earlier, "gold")
    newer = gold.select("site_product_identifier", "age_range", "kids_flag", "play_type")
    return write_table(newer, name, merge_schema=True, path=fresh_path(spark, "gold"))


def target_schema(spark, folder):
    before = spark.catalog.currentDatabase()
    schema = f"shop_{uuid4().hex}"
    try:
        use_schema(spark, schema, fresh_path(spark, "schema"))
        write_table(silver_catalogue(spark, folder), "silver_data")
        return read_table(spark, f"{schema}.silver_data").withColumn(
            "current_schema_is_target", F.lit(spark.catalog.currentDatabase() == schema)
        )
    finally:
        spark.catalog.setCurrentDatabase(before)


def temp_view_sql(spark, folder):
    view = register_view(regex_gold(silver_catalogue(spark, folder)), f"tagged_{uuid4().hex}")
    return spark.sql(
        f"SELECT age_range, sum(space_flag) AS space_products, count(*) AS products "
        f"FROM {view} GROUP BY age_range"
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_silver": csv_silver,
    "table_roundtrip": table_roundtrip,
    "schema_evolution": schema_evolution,
    "target_schema": target_schema,
    "temp_view_sql": temp_view_sql,
}

_tagged = {"tagged": SUBSTRING_SQL}

ORACLES = {
    "csv_roundtrip": with_steps(
        "catalogue",
        f"SELECT {PRODUCT}, availability_status, CAST(p_partkey AS varchar) AS p_partkey "
        "FROM catalogue",
    ),
    "csv_silver": with_steps("silver", f"SELECT {PRODUCT}, concatenated_text FROM silver"),
    "table_roundtrip": with_steps("silver", f"SELECT {PRODUCT}, concatenated_text FROM silver"),
    "schema_evolution": with_steps(
        "clean",
        "SELECT site_product_identifier, age_range, CAST(NULL AS INTEGER) AS name_length, "
        "CAST(CASE WHEN age_range = 'kids' THEN 1 ELSE 0 END AS INTEGER) AS kids_flag, play_type "
        "FROM tagged",
        _tagged,
    ),
    "target_schema": with_steps(
        "silver",
        f"SELECT {PRODUCT}, concatenated_text, true AS current_schema_is_target FROM silver",
    ),
    "temp_view_sql": with_steps(
        "clean",
        "SELECT age_range, CAST(sum(space_flag) AS BIGINT) AS space_products, "
        f"count(*) AS products FROM (SELECT *, {_flags_sql()} FROM tagged) GROUP BY age_range",
        _tagged,
    ),
}
