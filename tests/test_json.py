import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmark.functions.json_text import TAG_MAP, with_repaired_json, with_tag_map
from shelfmark.operators import tag_maps as ops

TEXTS = [
    None, "", " ", "unclear", "null", "true", "12", '"word"', "[]", "{}", '["a"]',
    '{"a":["x"]}', '  {"a": ["x", "y"], "b": []}\n', '{"a":[null]}', '{"a":null}', '{"a":"x"}',
    '{"a":{"b":1}}', '{"a":[1,true,2.5]}', '{"a":["x"]} more words', '```{"a":["x"]} more```',
    '{"a":["x"]}] more', '{"a":["x"]}} more', '1],[2', '1,"b":2', '{"a":1},{"b":2}',
    '{"a":["x"],"a":["y"]}', '```{"a":["x"],"b":["z"],"a":["y"]}```', '[{"a":["x"]}]',
    '[ {"a":["x"]} ]', '[{"a":["x"]},{"b":["y"]}]', '```json{"a":["x"]}```', "{'a':['x']}",
    "```{'a':['x']}```", '```{"a":["x\ny"]}```', '{"a":["caf\\u00e9 é"]}', '{"a":["x"],}',
    '{"a":[01]}', ' ' * 20_000 + 'x' + ' ' * 20_000 + 'y\n', '\u3000{"a":["x"]}\xa0\n', ' ```{"a":["x"]}``` ', '\x1f{"a":["x"]}\x1c', '{"z":["1"],"a":["2"]}',
]


def by_python(text):
    """The repair by the standard library's rules."""
    if text is None:
        return None
    core = text.replace("```", "").replace("[{", "{").replace("}]", "}").strip()
    try:
        return json.dumps(json.loads(core))
    except ValueError:
        return text


def maps(spark, texts):
    """Parsed maps of Spark's repair, and of the standard library's, as item lists."""
    rows = [(i, t, by_python(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string, expected string")
    df = with_tag_map(with_repaired_json(df, "t", "r"), "r", "m")
    df = df.withColumn("e", F.from_json("expected", TAG_MAP))
    items = [F.sort_array(F.map_entries(F.col(c))).cast("string").alias(c) for c in ("m", "e")]
    return [tuple(row) for row in df.select("t", *items).orderBy("i").collect()]


def test_repair_then_parse_equals_the_standard_library(spark):
    wrong = [row for row in maps(spark, TEXTS) if row[1] != row[2]]
    assert wrong == []


names = st.sampled_from(["Occasion", "Age Range", "Theme", 'q"uote', "é"])
tags = st.dictionaries(names, st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]), max_size=8), max_size=3), max_size=4)
wraps = st.sampled_from(["%s", "```%s```", " [%s] ", "```\n%s\n```", "%s tail", "```json\n%s```", "%s,", "[%s", "%s]"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(answers=st.lists(st.tuples(tags, wraps, st.booleans()), min_size=1, max_size=30))
def test_repair_of_generated_answers(spark, answers):
    texts = [wrap % json.dumps(tags, ensure_ascii=escape) for tags, wrap, escape in answers]
    assert [row for row in maps(spark, texts) if row[1] != row[2]] == []


def test_repaired_text_keeps_key_order_and_original(spark):
    df = spark.createDataFrame(
        [('```{"z": ["1"], "a": []}```',), ("```oops```",), ('"w"',), (None,)], "t string"
    )
    got = [r.r for r in with_repaired_json(df, "t", "r").collect()]
    assert got == ['{"z":["1"],"a":[]}', "```oops```", '"w"', None]


def parsed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return with_tag_map(df, "t", "m")


def test_explode_keys_and_values(spark):
    df = parsed(spark, '{"a":["x",null],"b":[]}', "{}", None, "no", '{"a":["x"]}')
    entries = ops.map_entries(df, "m", ["k"])
    assert [(r.k, r.Key) for r in entries.collect()] == [(0, "a"), (0, "b"), (4, "a")]
    values = ops.entry_values(entries, ["k"])
    assert [(r.k, r.Key, r.Value) for r in values.collect()] == [
        (0, "a", "x"), (0, "a", None), (4, "a", "x"),
    ]
    assert ops.collect_values(df, "m") == ["x"]


def test_too_many_values_are_refused_not_cut(spark):
    df = parsed(spark, json.dumps({"a": [str(i) for i in range(12)]}))
    assert len(ops.collect_values(df, "m", most=12)) == 12
    with pytest.raises(ValueError, match="flag_rows"):
        ops.collect_values(df, "m", most=11)


def flags(spark, *texts, **kw):
    df = parsed(spark, *texts)
    return ops.with_value_flags(df, "m", ops.collect_values(df, "m"), **kw).orderBy("k")


def test_flags_are_three_valued(spark):
    out = flags(
        spark,
        '{"Occasion":["Gift"],"Age Range":["Kids"]}',
        '{"Occasion":["Gift"]}',
        '{"Occasion":[],"Age Range":[]}',
        '{"Occasion":["Gift",null],"Age Range":[]}',
        "no",
    )
    assert [(r.flag_Gift, r.flag_Kids) for r in out.collect()] == [
        (1, 1), (1, None), (0, 0), (1, None), (None, None),
    ]


def test_flags_of_names_that_differ_in_case_are_merged(spark):
    out = flags(
        spark,
        '{"Occasion":["Kids"],"Age Range":["Big Set"]}',
        '{"Occasion":["kids"],"Age Range":[]}',
        '{"Occasion":["x"],"Age Range":[]}',
    )
    assert out.columns == ["k", "t", "m", "flag_Big_Set", "flag_Kids", "flag_x"]
    assert [r.flag_Kids for r in out.collect()] == [1, 1, 0]


def test_values_of_other_keys_get_flags_but_are_tested_on_the_two(spark):
    out = flags(spark, '{"Occasion":[],"Age Range":[],"Theme":["Space"]}')
    assert out.first().flag_Space == 0
    assert flags(spark, '{"Theme":["Space"]}', keys=["Theme"]).first().flag_Space == 1


def test_a_column_of_a_flags_name_is_replaced(spark):
    df = parsed(spark, '{"Occasion":["x"],"Age Range":[]}').withColumn("FLAG_X", F.lit("old"))
    out = ops.with_value_flags(df, "m", ["x"])
    assert out.columns == ["k", "t", "m", "flag_x"] and out.first().flag_x == 1


def test_odd_values_make_usable_columns(spark, tmp_path):
    df = parsed(spark, '{"Occasion":["a.b","c,d (e)","", "f`g"],"Age Range":[]}')
    out = ops.with_value_flags(df, "m", ops.collect_values(df, "m"))
    out.write.parquet(str(tmp_path / "odd"))
    assert set(spark.read.parquet(str(tmp_path / "odd")).columns) >= {
        "flag_", "flag_a.b", "flag_c,d_(e)", "flag_f`g",
    }


def test_flag_rows_hold_the_set_flags(spark):
    texts = ['{"Occasion":["A b","A b"],"Age Range":["C"]}', '{"Occasion":["C",null]}', "no"]
    df = parsed(spark, *texts)
    rows = {(r.k, r.flag) for r in ops.flag_rows(df, "m", "k").collect()}
    assert rows == {(0, "flag_A_b"), (0, "flag_C"), (1, "flag_C")}


def test_first_rows(spark):
    df = spark.range(100, 0, -1)
    assert [r.id for r in ops.first_rows(df, 3, ["id"]).collect()] == [1, 2, 3]
    assert ops.first_rows(df, None, ["id"]) is df
