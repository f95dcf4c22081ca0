"""Regex tags, the category cascade and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules

CLEAN = "new_concatenated_text_lower"
LOWER = "concatenated_text_lower"
FOUND = "_words_found"


def with_tags(
    df: DataFrame, patterns: dict[str, str], text: str = CLEAN, group: int = 0
) -> DataFrame:
    """One tag column per pattern: first match, '' if none, NULL if the text is NULL."""
    return df.withColumns(
        {tag: F.regexp_extract(text, pattern, group) for tag, pattern in patterns.items()}
    )


def with_rule_tags(
    df: DataFrame, rule_set: dict[str, list[str]], text: str = CLEAN, bounded: bool = False, fold_case: bool = True
) -> DataFrame:
    """One tag column per list of plain words: the first match of any, in the order listed where
    several begin at one place; '' if none, NULL if the text is NULL.

    The text is searched once for the words of all tags; each tag then takes the first word found
    that means something to it. Word lists that one pass cannot tell apart are searched one by one.
    """
    if fold_case:
        rule_set = {tag: [word.lower() for word in some] for tag, some in rule_set.items()}
    plan = rules.one_pass(rule_set, bounded)
    if plan is None:
        return with_tags(df, rules.tag_patterns(rule_set, bounded, fold_case=False), text)
    pattern, meant = plan
    none = F.when(F.col(text).isNotNull(), F.lit(""))
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), 1))
    columns = {tag: F.coalesce(_first_meant(words), none) for tag, words in meant.items()}
    return df.withColumn(FOUND, found).withColumns(columns).drop(FOUND)


def _first_meant(meant: dict[str, str]) -> Column:
    """What the first of the words found that the tag knows means to it; NULL if there is none."""
    if not meant:
        return F.lit(None).cast("string")
    word = F.get(F.filter(FOUND, lambda w: w.isin(list(meant))), 0)
    other = [F.lit(x) for pair in meant.items() if pair[0] != pair[1] for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*other), word), word) if other else word


def with_xmas_tag(df: DataFrame, text: str = LOWER, out: str = "is_christmas_present") -> DataFrame:
    return with_tags(df, {out: rules.word_pattern(rules.XMAS_WORDS, bounded=True)}, text)


def with_occasion_tag(df: DataFrame, text: str = CLEAN, out: str = "occasion_type") -> DataFrame:
    return with_tags(df, {out: rules.word_pattern(rules.OCCASION_WORDS, bounded=True)}, text)


def with_bounded_tags(df: DataFrame, text: str = CLEAN, fold_case: bool = True) -> DataFrame:
    """Seven word-bounded tags. ``fold_case=False`` keeps the rules as written."""
    return with_rule_tags(df, rules.BOUNDED_TAGS, text, True, fold_case)


def with_substring_tags(df: DataFrame, text: str = CLEAN) -> DataFrame:
    return with_rule_tags(df, rules.SUBSTRING_TAGS, text)


def with_group_tags(df: DataFrame, patterns: dict[str, str], text: str = CLEAN) -> DataFrame:
    """One column per caller-given pattern, holding its first capture group."""
    return with_tags(df, patterns, text, group=1)


def with_category(df: DataFrame, text: str = LOWER, out: str = "category") -> DataFrame:
    """The match of the last category that has one, else the unknown category."""
    steps = {f"_match_{name}": words for name, words in rules.CASCADE_TAGS.items()}
    found = [F.nullif(F.col(name), F.lit("")) for name in reversed(steps)]
    category = F.coalesce(*found, F.lit(rules.UNKNOWN_CATEGORY))
    return with_rule_tags(df, steps, text).withColumn(out, category).drop(*steps)


def with_flags(df: DataFrame) -> DataFrame:
    """The gold flags, never NULL: a NULL tag gives 0."""
    flags = {}
    for value, tags in rules.FLAG_SOURCES.items():
        hit = F.lit(False)
        for tag in tags:
            hit = hit | (F.col(tag) == value)
        flags[rules.flag_name(value)] = F.when(hit, 1).otherwise(0)
    return df.withColumns(flags)
