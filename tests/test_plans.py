"""The whole way: file, silver, gold, model gold, index, search; twice, with changes."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan
from registered.stand_ins import hashed_words
from shelfmark.operators.index import index_changes, refreshed, sync_index
from registered.stand_ins import rule_model
from shelfmark.plans.ingest import ingest
from shelfmark.plans.model_gold import tag_with_model
from shelfmark.plans.regex_gold import coverage, tag_catalogue
from shelfmark.plans.search import RESULT_COLUMNS, search
from shelfmark.sources.tables import use_schema, write_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER = (
    "availability_status,headline_text,product_name,product_description,category_name,"
    "site_product_identifier,other\n"
)
FIRST = [
    "E,New,Castle,Protect the treasure in the castle,Sets,1,x",
    "E,New,Racer,Fast cars for kids,Vehicles,2,x",
    "E,New,Racer copy,Fast cars for adults,Vehicles,2,x",
    "R_RETIRED,Old,Gone,Christmas special,Sets,3,x",
    ",Old,Unknown,Christmas special,Sets,4,x",
    "E,,Nameless,A star wars gift,Sets,5,x",
]
SECOND = [
    "E,New,Castle,Protect the treasure in the castle,Sets,1,x",
    "E,New,Racer,Faster cars for kids,Vehicles,2,x",
    "E,New,Ship,A space adventure,Sets,6,x",
]


def embedder():
    return hashed_words(256)


def test_the_whole_way_twice(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_whole", str(tmp_path / "db"))
    try:
        for number, lines in enumerate([FIRST, SECOND]):
            folder = tmp_path / f"csv{number}"
            folder.mkdir()
            (folder / "c.csv").write_text(HEADER + "\n".join(lines) + "\n")
            silver = ingest(spark, str(folder), "silver", ["product_name"], buckets=4)
            gold = tag_catalogue(spark, "silver", "gold", buckets=64)
            tagged = tag_with_model(spark, "silver", "answers", "model_gold", rule_model)
            changes = sync_index(silver, "idx", embedder, buckets=4)
            changed = {r[0]: r.change for r in changes.collect()}
            texts = spark.createDataFrame(
                [(1, "treasure castle"), (2, "cars for kids")], "query_id int, query_text string"
            )
            found = search(spark.table("idx"), gold, texts, embedder).collect()
            assert [r.product_name for r in found if r["rank"] == 1] == ["Castle", "Racer"]
            assert found[0].asDict().keys() >= set(RESULT_COLUMNS)
            counts = {r.category: (r.tagged, r.untagged) for r in coverage(gold).collect()}
            if number == 0:
                assert silver.count() == 3 and silver.columns[-1] == "concatenated_text"
                assert changed == {"1": "insert", "2": "insert"}
                assert counts["age_range"] == (1, 1)
                assert {r.kids_flag for r in gold.filter("site_product_identifier = '5'").collect()} == {0}
                assert "flag_Kids" in tagged.columns
                write_table(gold.withColumn("note", F.lit(None).cast("string")), "gold")
            else:
                assert changed == {"2": "update", "6": "insert"}
                assert gold.columns[-1] == "note" and gold.filter("note IS NOT NULL").count() == 0
                assert counts["theme_type"] == (2, 1)
        quiet = index_changes(spark.table("silver"), spark.table("idx"))
        assert quiet.count() == 0
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_whole CASCADE")


def test_synced_layout_needs_no_shuffle_for_the_diff(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_layout", str(tmp_path / "db"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(200).select(
            F.col("id").cast("string").alias("site_product_identifier"),
            F.concat(F.lit("text "), "id").alias("concatenated_text"),
        )
        silver = write_table(rows, "silver", bucket_by=(4, "site_product_identifier"))
        sync_index(silver, "idx", embedder, buckets=4)
        diff = index_changes(silver, spark.table("idx"))
        assert "Exchange" not in plan(diff) and diff.count() == 0
        changes = spark.createDataFrame(
            [("1", "update", 5)], "site_product_identifier string, change string, text_hash bigint"
        )
        new = plan(refreshed(silver, spark.table("idx"), changes, embedder))
        assert new.count("Exchange") == 1  # the changes; the index is joined where it lies
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_layout CASCADE")
