"""Catalogue, cleaning and tagging on the derived catalogue."""

from __future__ import annotations

from shelfmark.functions import rules, tags
from shelfmark.functions.text import with_clean_text
from shelfmark.operators import catalogue as ops
from shelfmark.operators.report import containing, tag_coverage as coverage_of, tagged_any
from shelfmark.plans.regex_gold import coverage, regex_gold

from .inputs import PRODUCT, raw_catalogue, silver_catalogue, with_steps

KEY = "site_product_identifier"
CLEAN = "new_concatenated_text_lower"
GROUP_PATTERNS = {"occasion": "(christmas|treat) ?(gift)?", "skill_level": "(begin|advanc)(ner|ed)"}


def clean_silver(spark, folder):
    return with_clean_text(silver_catalogue(spark, folder))


def live_filter(spark, folder):
    return ops.product_columns(
        ops.live_products(raw_catalogue(spark, folder)), ["availability_status", "p_partkey"]
    )


def counts(spark, folder):
    return ops.status_counts(raw_catalogue(spark, folder))


def dedupe(spark, folder):
    live = ops.product_columns(ops.live_products(raw_catalogue(spark, folder)), ["p_partkey"])
    return ops.with_description(ops.deduplicate(live, KEY, ["p_partkey"])).drop("p_partkey")


def clean_text(spark, folder):
    return clean_silver(spark, folder).select(
        KEY, "concatenated_text_lower", "cleaned_text", CLEAN
    )


def tag_xmas(spark, folder):
    return tags.with_xmas_tag(clean_silver(spark, folder)).select(KEY, "is_christmas_present")


def tag_occasion(spark, folder):
    return tags.with_occasion_tag(clean_silver(spark, folder)).select(KEY, "occasion_type")


def tag_bounded(spark, folder):
    return tags.with_bounded_tags(clean_silver(spark, folder)).select(KEY, *rules.BOUNDED_TAGS)


def tag_bounded_as_written(spark, folder):
    tagged = tags.with_bounded_tags(clean_silver(spark, folder), fold_case=False)
    return tagged.select(KEY, *rules.BOUNDED_TAGS)


def tag_sql(spark, folder):
    return tags.with_substring_tags(clean_silver(spark, folder)).select(KEY, *rules.SUBSTRING_TAGS)


def tag_category(spark, folder):
    return tags.with_category(clean_silver(spark, folder)).select(KEY, "category")


def tag_group1(spark, folder):
    tagged = tags.with_group_tags(clean_silver(spark, folder), GROUP_PATTERNS)
    return tagged.select(KEY, *GROUP_PATTERNS)


def tag_filter(spark, folder):
    tagged = tags.with_bounded_tags(clean_silver(spark, folder))
    wanted = {"occasion_type": "christmas", "age_range": "kids"}
    return tagged_any(tagged, wanted).select(KEY, *wanted)


def ilike_filter(spark, folder):
    return containing(clean_silver(spark, folder), "concatenated_text_lower", "%adults%")


def gold_flags(spark, folder):
    flags = [rules.flag_name(value) for value in rules.FLAG_SOURCES]
    return regex_gold(silver_catalogue(spark, folder)).select(KEY, *flags)


def gold_table(spark, folder):
    return regex_gold(silver_catalogue(spark, folder))


def tag_coverage(spark, folder):
    return coverage(regex_gold(silver_catalogue(spark, folder)))


def tag_coverage_bounded(spark, folder):
    return coverage_of(tags.with_bounded_tags(clean_silver(spark, folder)), list(rules.BOUNDED_TAGS))


QUERIES = {
    "catalogue_live_filter": live_filter,
    "catalogue_counts": counts,
    "catalogue_dedupe": dedupe,
    "silver_text": silver_catalogue,
    "clean_text": clean_text,
    "tag_xmas": tag_xmas,
    "tag_occasion": tag_occasion,
    "tag_bounded": tag_bounded,
    "tag_bounded_as_written": tag_bounded_as_written,
    "tag_sql": tag_sql,
    "tag_category": tag_category,
    "tag_group1": tag_group1,
    "tag_filter": tag_filter,
    "ilike_filter": ilike_filter,
    "gold_flags": gold_flags,
    "gold_table": gold_table,
    "tag_coverage": tag_coverage,
    "tag_coverage_bounded": tag_coverage_bounded,
}


def _tags_sql(patterns: dict[str, str]) -> str:
    """The SQL side matches the plain words, without the look-ahead."""
    found = ", ".join(f"regexp_extract({CLEAN}, '{p}') AS {tag}" for tag, p in patterns.items())
    return f"SELECT *, {found} FROM clean"


def _bounded_sql(fold_case: bool) -> str:
    words = {tag: "|".join(some) for tag, some in rules.BOUNDED_TAGS.items()}
    return _tags_sql(
        {tag: rf"\b({w.lower() if fold_case else w})\b" for tag, w in words.items()}
    )


SUBSTRING_SQL = _tags_sql({tag: "|".join(some) for tag, some in rules.SUBSTRING_TAGS.items()})
BOUNDED_SQL = _bounded_sql(fold_case=True)


def _flags_sql() -> str:
    return ", ".join(
        f"CAST(CASE WHEN '{value}' IN ({', '.join(sources)}) THEN 1 ELSE 0 END AS INTEGER) "
        f"AS {value.replace(' ', '_')}_flag"
        for value, sources in rules.FLAG_SOURCES.items()
    )


def _coverage_sql(tag_names) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{tag}' AS category, count(CASE WHEN {tag} <> '' THEN 1 END) AS tagged, "
        f"count(CASE WHEN {tag} = '' THEN 1 END) AS untagged FROM tagged"
        for tag in tag_names
    )


def _category_sql() -> str:
    """Asks the categories from the last to the first."""
    whens = " ".join(
        f"WHEN regexp_matches(concatenated_text_lower, '{p}') "
        f"THEN regexp_extract(concatenated_text_lower, '{p}')"
        for p in ("|".join(some) for some in reversed(rules.CASCADE_TAGS.values()))
    )
    return f"CASE {whens} ELSE 'Unknown' END AS category"


_bounded = {"tagged": BOUNDED_SQL}
_as_written = {"tagged": _bounded_sql(fold_case=False)}
_substring = {"tagged": SUBSTRING_SQL}
_bounded_names = ", ".join(rules.BOUNDED_TAGS)
_substring_names = ", ".join(rules.SUBSTRING_TAGS)

ORACLES = {
    "catalogue_live_filter": with_steps(
        "live", f"SELECT {PRODUCT}, availability_status, p_partkey FROM live"
    ),
    "catalogue_counts": with_steps(
        "catalogue",
        "SELECT count(*) AS original_count, count(CASE WHEN availability_status <> 'R_RETIRED' "
        "THEN 1 END) AS filtered_count FROM catalogue",
    ),
    "catalogue_dedupe": with_steps("deduped", f"SELECT {PRODUCT} FROM deduped"),
    "silver_text": with_steps("silver", f"SELECT {PRODUCT}, concatenated_text FROM silver"),
    "clean_text": with_steps(
        "clean", f"SELECT {KEY}, concatenated_text_lower, cleaned_text, {CLEAN} FROM clean"
    ),
    "tag_xmas": with_steps(
        "clean",
        rf"SELECT {KEY}, regexp_extract(concatenated_text_lower, '\b(christmas|xmas)\b') "
        "AS is_christmas_present FROM clean",
    ),
    "tag_occasion": with_steps(
        "clean",
        rf"SELECT {KEY}, regexp_extract({CLEAN}, "
        r"'\b(christmas|birthday|holiday|everyday|special|treat)\b') AS occasion_type FROM clean",
    ),
    "tag_bounded": with_steps("clean", f"SELECT {KEY}, {_bounded_names} FROM tagged", _bounded),
    "tag_bounded_as_written": with_steps(
        "clean", f"SELECT {KEY}, {_bounded_names} FROM tagged", _as_written
    ),
    "tag_sql": with_steps("clean", f"SELECT {KEY}, {_substring_names} FROM tagged", _substring),
    "tag_category": with_steps("clean", f"SELECT {KEY}, {_category_sql()} FROM clean"),
    "tag_group1": with_steps(
        "clean",
        f"SELECT {KEY}, "
        + ", ".join(
            f"regexp_extract({CLEAN}, '{pattern}', 1) AS {name}"
            for name, pattern in GROUP_PATTERNS.items()
        )
        + " FROM clean",
    ),
    "tag_filter": with_steps(
        "clean",
        f"SELECT {KEY}, occasion_type, age_range FROM tagged "
        "WHERE occasion_type = 'christmas' OR age_range = 'kids'",
        _bounded,
    ),
    "ilike_filter": with_steps(
        "clean",
        "SELECT concatenated_text_lower FROM clean WHERE concatenated_text_lower ILIKE '%adults%'",
    ),
    "gold_flags": with_steps("clean", f"SELECT {KEY}, {_flags_sql()} FROM tagged", _substring),
    "gold_table": with_steps("clean", f"SELECT *, {_flags_sql()} FROM tagged", _substring),
    "tag_coverage": with_steps("clean", _coverage_sql(rules.SUBSTRING_TAGS), _substring),
    "tag_coverage_bounded": with_steps("clean", _coverage_sql(rules.BOUNDED_TAGS), _bounded),
}
