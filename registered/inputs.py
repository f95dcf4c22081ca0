"""The product catalogue that the queries derive from the part table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.catalogue import silver

# The same text runs in both engines.
CATALOGUE = """
SELECT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS headline_text,
       p_name AS product_name,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE concat('A ', p_name, ' for ',
         CASE p_partkey % 9 WHEN 0 THEN 'Christmas' WHEN 1 THEN 'kids, space'
           WHEN 2 THEN 'Star Wars' WHEN 3 THEN 'adults - building sets'
           WHEN 4 THEN 'advanced strategy' WHEN 5 THEN 'display'
           WHEN 6 THEN 'special treat' WHEN 7 THEN 'Comics & books' ELSE 'nothing' END,
         '!') END AS product_description,
       p_type AS category_name,
       CAST(CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS {string})
         AS site_product_identifier,
       CASE p_size % 5 WHEN 0 THEN 'R_RETIRED' WHEN 1 THEN NULL ELSE 'E_AVAILABLE' END
         AS availability_status,
       p_partkey
FROM {source}
"""

PRODUCT = (
    "headline_text, product_name, product_description, category_name, site_product_identifier"
)

# Named steps for the SQL side.
STEPS = {
    "catalogue": CATALOGUE.format(string="varchar", source="part"),
    "live": "SELECT * FROM catalogue WHERE availability_status <> 'R_RETIRED'",
    "deduped": f"""
SELECT {PRODUCT} FROM (
  SELECT *, row_number() OVER (PARTITION BY site_product_identifier ORDER BY p_partkey) AS n
  FROM live) WHERE n = 1 AND product_description IS NOT NULL""",
    "silver": f"""
SELECT {PRODUCT},
       headline_text || ' | ' || product_name || ' | ' || product_description || ' | '
         || category_name || ' | ' || site_product_identifier AS concatenated_text
FROM deduped""",
    "clean": """
SELECT *, regexp_replace(cleaned_text, '[^a-zA-Z0-9\\s]', '', 'g') AS new_concatenated_text_lower
FROM (SELECT *, regexp_replace(concatenated_text_lower, '[.,!?]', '', 'g') AS cleaned_text
      FROM (SELECT *, lower(concatenated_text) AS concatenated_text_lower FROM silver))""",
}


def with_steps(last: str, body: str, more: dict[str, str] | None = None) -> str:
    """A WITH query over the named steps up to ``last`` and the ``more`` ones."""
    names = list(STEPS)
    steps = {name: STEPS[name] for name in names[: names.index(last) + 1]} | (more or {})
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items()) + "\n" + body


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    sql = CATALOGUE.format(string="string", source="{part}")
    return spark.sql(sql, part=table(spark, folder, "part"))


def silver_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return silver(raw_catalogue(spark, folder), order=["p_partkey"])
