import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import rules
from shelfmark.functions.prompts import with_prompt
from registered.stand_ins import rule_model
from shelfmark.operators import tag_maps
from shelfmark.operators.model import with_model_tags
from shelfmark.plans.model_gold import tag_with_model
from shelfmark.sources.tables import use_schema


def products(spark, *texts):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)],
        "site_product_identifier string, concatenated_text string",
    )


def test_prompt_holds_description_and_all_values(spark):
    row = with_prompt(products(spark, "a {red} $1 \\ brick", None).orderBy("site_product_identifier")).collect()
    assert "a {red} $1 \\ brick" in row[0].system_prompt
    assert rules.DESCRIPTION_SLOT not in row[0].system_prompt
    for category, values in rules.MODEL_TAGS.items():
        assert category in row[0].system_prompt
        assert all(value in row[0].system_prompt for value in values)
    assert row[0].user_prompt == rules.MODEL_QUESTION
    assert row[1].system_prompt is None


def test_model_is_made_once_per_partition_and_sees_settings(spark):
    made = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def make(settings):
        made.add(1)

        def model(requests):
            calls.add(len(requests))
            assert len(requests) <= 5
            return [f"{settings['max_tokens']}|{r.question}|{r.description}|{len(r.system)}" for r in requests]

        return model

    df = products(spark, *[f"text {i}" for i in range(40)], None)
    out = with_model_tags(df, make, partitions=2, batch=5)
    assert out.rdd.getNumPartitions() == 2
    rows = {r.concatenated_text: r.tagged_description for r in out.collect()}
    assert made.value == 2 and calls.value == 40
    assert rows[None] is None
    assert rows["text 7"].startswith(f"500|{rules.MODEL_QUESTION}|text 7|")


def test_wrong_number_of_answers_is_an_error(spark):
    df = products(spark, "a", "b")
    with pytest.raises(Exception, match="answers"):
        with_model_tags(df, lambda settings: lambda requests: ["one"], partitions=1).collect()


def test_answers_are_not_asked_twice_for_a_filter(spark):
    calls = spark.sparkContext.accumulator(0)

    def make(settings):
        def model(requests):
            calls.add(len(requests))
            return ["x" for _ in requests]

        return model

    df = products(spark, "a", "b", "c")
    with_model_tags(df, make).filter(F.col("tagged_description") == "x").collect()
    assert calls.value == 3


def test_rule_model_answers_json():
    from shelfmark.operators.model import Request

    text = rule_model({})([Request("", "", "Star Wars vehicles for kids this christmas")])[0]
    assert json.loads(text.strip("`")) == {
        "Age Range": ["Kids"], "Franchise": ["Star Wars"], "Occasion": ["Christmas Gift"],
        "Product Type": ["Vehicles"],
    }


def test_tagging_run(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_model", str(tmp_path / "m"))
    try:
        products(spark, "christmas for kids", "space adults", None, "zzz").write.saveAsTable("silver")
        calls = spark.sparkContext.accumulator(0)

        def make(settings):
            inner = rule_model(settings)

            def model(requests):
                calls.add(len(requests))
                return inner(requests)

            return model

        gold = tag_with_model(spark, "silver", "answers", "gold", make)
        assert calls.value == 3
        flags = [c for c in gold.columns if c.startswith("flag_")]
        assert flags == ["flag_Adults", "flag_Christmas_Gift", "flag_Kids", "flag_Space"]
        rows = {r.concatenated_text: r for r in gold.collect()}
        assert rows["christmas for kids"].flag_Kids == 1
        assert rows["space adults"].flag_Kids is None
        assert rows[None].flag_Adults is None
        tag_with_model(spark, "silver", "answers", "gold", make)
        assert calls.value == 3
        assert {tuple(r) for r in spark.table("gold_flags").collect()} >= {("0", "flag_Kids"), ("1", "flag_Adults")}
        named = tag_with_model(spark, "silver", "answers", "gold", make, values=["Space", "Marvel"])
        assert [c for c in named.columns if c.startswith("flag_")] == ["flag_Marvel", "flag_Space"]
        few = tag_with_model(spark, "silver", "answers", "gold", rule_model, n=1)
        assert [r.concatenated_text for r in few.collect()] == ["christmas for kids"]
        assert "flag_Space" not in few.columns
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_model CASCADE")


def test_a_failed_run_keeps_the_parts_it_has_written(spark, tmp_path):
    from shelfmark.plans.model_gold import answers_kept

    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_rounds", str(tmp_path / "r"))
    try:
        source = products(spark, *[f"text {i}" for i in range(60)])
        calls = spark.sparkContext.accumulator(0)

        def model_for(broken):
            def make(settings):
                def model(requests):
                    calls.add(len(requests))
                    if broken and any(r.description == "text 0" for r in requests):
                        raise ValueError("model down")
                    return ["[]"] * len(requests)

                return model

            return make

        with pytest.raises(Exception, match="model down"):
            answers_kept(spark, source, "memory", model_for(True), 3, rounds=6)
        kept = spark.table("memory").count() if spark.catalog.tableExists("memory") else 0
        first = calls.value
        assert answers_kept(spark, source, "memory", model_for(False), 3, rounds=6).count() == 60
        assert calls.value - first == 60 - kept
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_rounds CASCADE")


def test_first_rows_are_asked_by_many_tasks_and_thousands_of_values_give_flags(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_values", str(tmp_path / "v"))
    try:
        products(spark, *[f"text {i}" for i in range(60)]).write.saveAsTable("silver")
        made = spark.sparkContext.accumulator(0)

        def make(settings):
            made.add(1)
            return lambda requests: [
                json.dumps({"Occasion": [f"v{r.description[5:]}x{j}" for j in range(50)]}) for r in requests
            ]

        gold = tag_with_model(spark, "silver", "answers", "gold", make, n=60, values=["v0x0"])
        assert made.value == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.table("gold_flags").select("flag").distinct().count() == 3000
        assert gold.columns[-1] == "flag_v0x0"
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_values CASCADE")


def parsed(spark, rows):
    return spark.createDataFrame(rows, "k string, tags map<string,array<string>>")


def test_values_keep_their_numbers(spark):
    first = parsed(spark, [("a", {"Occasion": ["x", "y"], "Theme": ["t", None]}), ("b", None), ("c", {"Age Range": ["x"]})])
    before = tag_maps.value_numbers(first, "tags")
    old = {r.value: r.number for r in before.collect()}
    assert sorted(old) == ["t", "x", "y"] and sorted(old.values()) == [0, 1, 2]
    then = parsed(spark, [("a", {"Occasion": ["x", "new"]}), ("a", {"Age Range": ["z", "x"]}), ("d", {"Theme": ["t"]}), ("e", None)])
    numbers = tag_maps.value_numbers(then, "tags", before)
    new = {r.value: r.number for r in numbers.collect()}
    assert {v: new[v] for v in old} == old and sorted(new) == ["new", "t", "x", "y", "z"] and sorted(new.values()) == [0, 1, 2, 3, 4]
    rows = {r.k: r.flag_numbers for r in tag_maps.with_flag_numbers(then, numbers, "tags", "k").collect()}
    assert rows == {"a": sorted([new["x"], new["new"], new["z"]]), "d": [], "e": []}
    assert tag_maps.value_numbers(parsed(spark, []), "tags", before).count() == 3


def test_a_hundred_thousand_values(spark):
    rows = spark.range(10_000).select(
        F.col("id").cast("string").alias("k"),
        F.create_map(F.lit("Occasion"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("v"), (F.col("id") * 10 + i).cast("string")))).alias("tags"),
    )
    numbers = tag_maps.value_numbers(rows, "tags")
    span = numbers.agg(F.count("value"), F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(span) == (100_000, 0, 99_999, 100_000)
    assert tag_maps.with_flag_numbers(rows, numbers, "tags", "k").where("size(flag_numbers) = 10").count() == 10_000


def test_a_round_writes_its_own_answers_only(spark, tmp_path):
    from shelfmark.plans.model_gold import answers_kept, compact_answers

    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_memory", str(tmp_path / "a"))
    folder = tmp_path / "a" / "memory__rows"
    try:
        calls = spark.sparkContext.accumulator(0)

        def make(settings):
            def model(requests):
                calls.add(len(requests))
                return ["[]"] * len(requests)

            return model

        def ask(a, b):
            source = products(spark, *[f"text {i}" for i in range(a, b)], None)
            rows = answers_kept(spark, source, "memory", make, 2)
            assert rows.where("tagged_description = '[]'").count() == b - a
            return {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}

        first = ask(0, 40)
        second = ask(20, 45)
        assert calls.value == 45 and first.items() <= second.items() and len(second) > len(first)
        assert ask(0, 45) == second
        compact_answers(spark, "memory")
        assert spark.table("memory").count() == 45 and ask(0, 45) and calls.value == 45
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_memory CASCADE")


def test_too_many_columns_are_refused(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_most", str(tmp_path / "w"))
    try:
        products(spark, "christmas for kids", "space adults").write.saveAsTable("silver")
        with pytest.raises(ValueError, match="more than 2"):
            tag_with_model(spark, "silver", "answers", "gold", rule_model, most_columns=2)
        gold = tag_with_model(spark, "silver", "answers", "gold", rule_model, values=[], most_columns=2)
        assert not [c for c in gold.columns if c.startswith("flag_")]
        assert spark.table("gold_values").count() >= 4 and spark.table("gold_flags").count() >= 3
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_most CASCADE")
