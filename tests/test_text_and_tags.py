import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import FOLDER
from shelfmark.functions import rules, tags
from shelfmark.functions.text import strip_punctuation, strip_specials, with_clean_text
from shelfmark.operators.report import containing, tag_coverage, tagged_any
from shelfmark.plans.regex_gold import regex_gold


def texts(spark, *values, name="new_concatenated_text_lower"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


def test_cleaning(spark):
    df = texts(spark, "A | B!", "Ça va, été?", None, "", "x\t\n\x0b\x0c\ry", "_1-2", name="concatenated_text")
    rows = with_clean_text(df).collect()
    assert [r.concatenated_text_lower for r in rows] == [
        "a | b!", "ça va, été?", None, "", "x\t\n\x0b\x0c\ry", "_1-2",
    ]
    assert [r.cleaned_text for r in rows] == ["a | b", "ça va été", None, "", "x\t\n\x0b\x0c\ry", "_1-2"]
    assert [r.new_concatenated_text_lower for r in rows] == [
        "a  b", "a va t", None, "", "x\t\n\x0b\x0c\ry", "12",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_listed_class_equals_the_ranges(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    df = texts(spark, *values, name="t")
    once = df.select(strip_specials(F.col("t")).alias("t"))
    assert column(once, "t") == [re.sub(r"[^a-zA-Z0-9\s]", "", v, flags=re.A) for v in values]
    assert column(once.select(strip_specials(strip_punctuation(F.col("t"))).alias("t")), "t") == column(once, "t")


def test_xmas_tag_is_bounded_text(spark):
    df = texts(spark, None, "", "a xmas", "_xmas", "my christmas, xmas", "christmases", name="concatenated_text_lower")
    assert column(tags.with_xmas_tag(df), "is_christmas_present") == [None, "", "xmas", "", "christmas", ""]


def test_occasion_tag(spark):
    df = texts(spark, "a special treat", "specials", "treat special", None)
    assert column(tags.with_occasion_tag(df), "occasion_type") == ["special", "", "treat", None]


def test_bounded_and_substring_rules_differ(spark):
    df = texts(spark, "displaying giftsets for kidsroom", "dc comics special treat", "building sets")
    bounded = tags.with_bounded_tags(df).collect()
    loose = tags.with_substring_tags(df).collect()
    assert [r.occasion_type for r in bounded] == ["", "special treat", ""]
    assert [r.occasion_type for r in loose] == ["gift", "special", ""]
    assert [r.age_range for r in bounded] == ["", "", ""]
    assert [r.age_range for r in loose] == ["kids", "", ""]
    assert [r.franchise_type for r in bounded] == ["", "dc", ""]
    assert [r.franchise_type for r in loose] == ["", "dc comics", ""]
    assert [r.product_type for r in bounded] == ["", "comics", "building sets"]
    assert [r.product_type for r in loose] == ["sets", "comics", "building"]


def test_rules_as_written_keep_their_case(spark):
    df = texts(spark, "comics and books")
    assert column(tags.with_bounded_tags(df), "product_type") == ["comics"]
    assert column(tags.with_bounded_tags(df, fold_case=False), "product_type") == ["books"]


def test_leftmost_match_decides(spark):
    df = texts(spark, "trucks before adventure", "adventure before trucks")
    assert column(tags.with_substring_tags(df), "theme_type") == ["trucks", "adventure"]


def test_last_category_with_a_match_wins(spark):
    df = texts(
        spark, None, "plain", "christmas", "christmas kids", "display", "kids play sets",
        "harry potter", name="concatenated_text_lower",
    )
    assert column(tags.with_category(df), "category") == [
        "Unknown", "Unknown", "christmas", "kids", "play", "sets", "harry",
    ]


def test_group_tags_use_group_one(spark):
    df = texts(spark, "christmas gift", "none", None)
    out = tags.with_group_tags(df, {"kind": "(christmas) (gift)", "skill": "(beginner|advanced)"})
    assert column(out, "kind") == ["christmas", "", None]
    assert column(out, "skill") == ["", "", None]


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("rule_set", ["BOUNDED_TAGS", "SUBSTRING_TAGS", "CASCADE_TAGS"])
def test_look_ahead_changes_no_match(bounded, rule_set):
    words = sorted({w.lower() for ws in getattr(rules, rule_set).values() for w in ws})
    samples = [f"{a}{glue}{b}" for a in words for b in words for glue in ("", " ", "x")]
    for tag, some in getattr(rules, rule_set).items():
        some = [w.lower() for w in some]
        plain = "|".join(some)
        plain = rf"\b({plain})\b" if bounded else f"({plain})"
        guarded = re.compile(rules.word_pattern(some, bounded))
        for sample in samples:
            expected, got = re.search(plain, sample), guarded.search(sample)
            assert (got and got.span(1)) == (expected and expected.span(1)), (tag, sample)


def test_twenty_eight_flags_never_null(spark):
    silver = spark.createDataFrame(
        [("1", "A Star Wars building set for kids"), ("2", None), ("3", "gift & treat")],
        "site_product_identifier string, concatenated_text string",
    )
    rows = regex_gold(silver).collect()
    flags = [rules.flag_name(v) for v in rules.FLAG_SOURCES]
    assert len(flags) == len(set(flags)) == 28
    on = [{f for f in flags if row[f] == 1} for row in rows]
    assert on == [{"star_wars_flag", "building_flag", "kids_flag"}, set(), {"gift_flag"}]
    assert all(row[f] in (0, 1) for row in rows for f in flags)
    assert [row.age_range for row in rows] == ["kids", None, ""]


def test_coverage_counts(spark):
    df = spark.createDataFrame([("x", ""), ("", None), (None, None), ("y", "z")], "a string, b string")
    rows = {r.category: (r.tagged, r.untagged) for r in tag_coverage(df, ["a", "b"]).collect()}
    assert rows == {"a": (2, 1), "b": (1, 1)}


def test_coverage_adds_up_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tagged = tags.with_bounded_tags(with_clean_text(docs, "text"))
    total = docs.count()
    for row in tag_coverage(tagged, list(rules.BOUNDED_TAGS)).collect():
        assert row.tagged + row.untagged == total
    for tag, words in rules.BOUNDED_TAGS.items():
        allowed = {w.lower() for w in words} | {""}
        assert {r[0] for r in tagged.select(tag).distinct().collect()} <= allowed


def test_tag_filter_and_ilike(spark):
    df = spark.createDataFrame(
        [("christmas", ""), ("", "kids"), ("", "adults"), (None, None)],
        "occasion_type string, age_range string",
    )
    assert tagged_any(df, {"occasion_type": "christmas", "age_range": "kids"}).count() == 2
    assert column(containing(df, "age_range", "%DULT%"), "age_range") == ["adults"]


def test_words_with_signs(spark):
    from shelfmark.functions.rules import word_pattern

    rows = ["a 3-in-1 set", "learn c++ now", "a^b", "[x]", "ab", "c", "x", "c++c"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    words = ["3-in-1", "c++", "a^b", "[x]"]
    for bounded in (False, True):
        pattern = word_pattern(words, bounded)
        got = {r.t: r.m for r in df.select("t", F.regexp_extract("t", pattern, 0).alias("m")).collect()}
        assert [got[r] for r in rows[:4]] == words
        assert [got[r] for r in rows[4:7]] == ["", "", ""]
