"""Tags, category and flags on texts that hold every word of every rule set.

One text per part, of two words. The SQL states words and conditions itself, apart from the
package's rules, so that a wrong or missing word shows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import tags
from shelfmark.operators.report import tag_coverage

from .inputs import table

# The words of all rule sets, and some of none.
WORDS = (
    "christmas,birthday,holiday,everyday,special treat,special,treat,gift,preschool,kids,teenagers,adults,"
    "adventure,animals,cars,trucks,cars and trucks,fantasy,space,superheroes,beginner,intermediate,advanced,"
    "building,construction,imaginative,play,action,strategy,puzzle,star wars,harry potter,harry,potter,"
    "marvel,dc comics,dc,comics,disney,pixar,building sets,sets,vehicles,minifigures,accessories,books,"
    "nothing,plain,displayed,spacecraft,xmas"
)
COUNT = WORDS.count(",") + 1
TEXTS = f"""
SELECT p_partkey, lower(concat('A ', split_part('{WORDS}', ',', CAST(p_partkey % {COUNT} AS INT) + 1), ' for ',
         split_part('{WORDS}', ',', CAST((p_partkey * 7 + p_size) % {COUNT} AS INT) + 1), ' here')) AS text
FROM {{source}}"""

BOUNDED = {
    "occasion_type": r"\b(christmas|birthday|holiday|everyday|special treat)\b",
    "age_range": r"\b(preschool|kids|teenagers|adults)\b",
    "theme_type": r"\b(adventure|animals|cars|trucks|fantasy|space|superheroes)\b",
    "skill_level": r"\b(beginner|intermediate|advanced)\b",
    "play_style": r"\b(building|construction|imaginative|action|adventure|strategy|puzzle)\b",
    "franchise_type": r"\b(star wars|harry potter|marvel|dc|comics|disney|pixar)\b",
    "product_type": r"\b(building sets|vehicles|minifigures|accessories|books|comics)\b",
}
SUBSTRING = {
    "occasion_type": "christmas|birthday|holiday|everyday|special|treat|gift",
    "age_range": "preschool|kids|teenagers|adults",
    "theme_type": "adventure|animals|cars|trucks|fantasy|space|superheroes",
    "skill_level": "beginner|intermediate|advanced",
    "play_type": "building|construction|imaginative|action|adventure|strategy|puzzle",
    "franchise_type": "star wars|harry potter|marvel|dc comics|disney|pixar",
    "product_type": "building|sets|vehicles|minifigures|accessories|books|comics",
}
CASCADE = [
    "christmas|birthday|holiday|everyday|special|treat",
    "preschool|kids|teenagers|adults",
    "adventure|animals|cars and trucks|fantasy|space|superheroes",
    "beginner|intermediate|advanced",
    "building|construction|imaginative|play|action|adventure|strategy|puzzle",
    "star wars|harry|potter|marvel|dc|comics|disney|pixar",
    "building|sets|vehicles|minifigures|accessories|books|comics",
]
FLAGS = {
    "action_flag": "play_type = 'action'",
    "star_wars_flag": "franchise_type = 'star wars'",
    "special_flag": "occasion_type = 'special'",
    "minifigures_flag": "product_type = 'minifigures'",
    "building_flag": "play_type = 'building' OR theme_type = 'building'",
    "accessories_flag": "product_type = 'accessories'",
    "sets_flag": "product_type = 'sets'",
    "animals_flag": "theme_type = 'animals'",
    "holiday_flag": "occasion_type = 'holiday'",
    "kids_flag": "age_range = 'kids'",
    "gift_flag": "occasion_type = 'gift'",
    "advanced_flag": "skill_level = 'advanced'",
    "adventure_flag": "theme_type = 'adventure'",
    "disney_flag": "franchise_type = 'disney'",
    "marvel_flag": "franchise_type = 'marvel'",
    "trucks_flag": "theme_type = 'trucks'",
    "vehicles_flag": "product_type = 'vehicles'",
    "comics_flag": "product_type = 'comics'",
    "strategy_flag": "play_type = 'strategy'",
    "construction_flag": "play_type = 'construction'",
    "space_flag": "theme_type = 'space'",
    "christmas_flag": "occasion_type = 'christmas'",
    "everyday_flag": "occasion_type = 'everyday'",
    "adults_flag": "age_range = 'adults'",
    "birthday_flag": "occasion_type = 'birthday'",
    "treat_flag": "occasion_type = 'treat'",
    "harry_potter_flag": "franchise_type = 'harry potter'",
    "cars_flag": "theme_type = 'cars'",
}


def _texts(spark, folder):
    return spark.sql(TEXTS.format(source="{part}"), part=table(spark, folder, "part"))


def word_tags_bounded(spark, folder):
    return tags.with_bounded_tags(_texts(spark, folder), "text")


def word_tags_substring(spark, folder):
    return tags.with_substring_tags(_texts(spark, folder), "text")


def word_category(spark, folder):
    return tags.with_category(_texts(spark, folder), "text")


def word_flags(spark, folder):
    return tags.with_flags(word_tags_substring(spark, folder))


def word_flag_counts(spark, folder):
    """How many texts set each flag: none is always or never set."""
    flagged = word_flags(spark, folder)
    return flagged.agg(*(F.sum(n).alias(n) for n in FLAGS), F.count("*").alias("texts"))


def word_coverage(spark, folder):
    return tag_coverage(word_tags_bounded(spark, folder), list(BOUNDED))


QUERIES = {
    "word_tags_bounded": word_tags_bounded,
    "word_tags_substring": word_tags_substring,
    "word_category": word_category,
    "word_flags": word_flags,
    "word_flag_counts": word_flag_counts,
    "word_coverage": word_coverage,
}

_texts_sql = TEXTS.format(source="part")


def _tagged(patterns: dict[str, str]) -> str:
    found = ", ".join(f"regexp_extract(text, '{p}') AS {tag}" for tag, p in patterns.items())
    return f"SELECT *, {found} FROM ({_texts_sql})"


_whens = " ".join(
    f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}')" for p in reversed(CASCADE)
)
_flagged = f"SELECT *, {', '.join(f'CAST({c} AS INTEGER) AS {n}' for n, c in FLAGS.items())} FROM ({_tagged(SUBSTRING)})"

ORACLES = {
    "word_tags_bounded": _tagged(BOUNDED),
    "word_tags_substring": _tagged(SUBSTRING),
    "word_category": f"SELECT *, CASE {_whens} ELSE 'Unknown' END AS category FROM ({_texts_sql})",
    "word_flags": _flagged,
    "word_flag_counts": "SELECT "
    + ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in FLAGS)
    + f", count(*) AS texts FROM ({_flagged})",
    "word_coverage": "\nUNION ALL ".join(
        f"SELECT '{tag}' AS category, count(CASE WHEN {tag} <> '' THEN 1 END) AS tagged, "
        f"count(CASE WHEN {tag} = '' THEN 1 END) AS untagged FROM ({_tagged(BOUNDED)})"
        for tag in BOUNDED
    ),
}
