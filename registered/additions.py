"""A catalogue that arrives in several deliveries, with survivors, gold and coverage kept up."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from shelfmark.plans.additions import add_to_catalogue, kept_coverage, silver_of, tag_additions
from shelfmark.sources.shared import fresh_path
from shelfmark.sources.tables import use_schema

from .catalogue import ORACLES as CATALOGUE_SQL
from .inputs import raw_catalogue

PARTS = 16
DELIVERIES = 3


def _deliver(spark, folder, after):
    """Every row arrives in one of the deliveries, the last of which comes a second time.

    Rows of a product come in different ones, later rows before earlier ones too.
    """
    raw = raw_catalogue(spark, folder)
    number = F.pmod(F.xxhash64("p_partkey"), F.lit(DELIVERIES))
    for i in [*range(DELIVERIES), DELIVERIES - 1]:
        add_to_catalogue(raw.where(number == i), "survivors", PARTS, ["p_partkey"])
        after()


def _in_own_schema(spark, run):
    before = spark.catalog.currentDatabase()
    try:
        use_schema(spark, f"shop_{uuid4().hex}", fresh_path(spark, "schema"))
        return run()
    finally:
        spark.catalog.setCurrentDatabase(before)


def silver_additions(spark, folder):
    def run():
        _deliver(spark, folder, lambda: None)
        return silver_of(spark, "survivors")

    return _in_own_schema(spark, run)


def gold_additions(spark, folder):
    def run():
        _deliver(spark, folder, lambda: tag_additions(spark, "survivors", "gold"))
        return spark.table("gold")

    return _in_own_schema(spark, run)


def coverage_additions(spark, folder):
    def run():
        _deliver(spark, folder, lambda: tag_additions(spark, "survivors", "gold"))
        return kept_coverage(spark, "gold")

    return _in_own_schema(spark, run)


QUERIES = {
    "silver_additions": silver_additions,
    "gold_additions": gold_additions,
    "coverage_additions": coverage_additions,
}

# What a single run over all rows gives.
ORACLES = {
    "silver_additions": CATALOGUE_SQL["silver_text"],
    "gold_additions": CATALOGUE_SQL["gold_table"],
    "coverage_additions": CATALOGUE_SQL["tag_coverage"],
}
