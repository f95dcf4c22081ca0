"""Cleaning and tagging of whole documents: long, multi-line, four languages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import rules, tags
from shelfmark.functions.text import with_clean_text
from shelfmark.operators.report import tag_coverage
from shelfmark.sources.tables import spread

from .catalogue import BOUNDED_SQL, SUBSTRING_SQL, _category_sql, _coverage_sql
from .inputs import table

CLEAN = "new_concatenated_text_lower"
# Words the documents are full of, next to the catalogue's own.
WORD_PATTERNS = {"first_the": r"\b(then|the|there)\b", "first_word": "(de|en|la|und)"}


def clean_documents(spark, folder):
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return with_clean_text(spread(texts, "doc_id"), "text")


def documents_clean(spark, folder):
    return clean_documents(spark, folder).select("doc_id", "cleaned_text", CLEAN)


def documents_words(spark, folder):
    return tags.with_group_tags(clean_documents(spark, folder), WORD_PATTERNS).select(
        "doc_id", *WORD_PATTERNS
    )


def documents_tags(spark, folder):
    tagged = tags.with_substring_tags(clean_documents(spark, folder))
    return tagged.select("doc_id", *rules.SUBSTRING_TAGS)


def documents_category(spark, folder):
    return tags.with_category(clean_documents(spark, folder)).groupBy("category").agg(
        F.count(F.lit(1)).alias("documents")
    )


def documents_coverage(spark, folder):
    tagged = tags.with_substring_tags(clean_documents(spark, folder))
    return tag_coverage(tagged, list(rules.SUBSTRING_TAGS))


def documents_bounded_coverage(spark, folder):
    tagged = tags.with_bounded_tags(clean_documents(spark, folder))
    return tag_coverage(tagged, list(rules.BOUNDED_TAGS))


QUERIES = {
    "documents_clean": documents_clean,
    "documents_words": documents_words,
    "documents_tags": documents_tags,
    "documents_category": documents_category,
    "documents_coverage": documents_coverage,
    "documents_bounded_coverage": documents_bounded_coverage,
}

_clean = r"""clean AS (
SELECT *, regexp_replace(cleaned_text, '[^a-zA-Z0-9\s]', '', 'g') AS new_concatenated_text_lower
FROM (SELECT *, regexp_replace(concatenated_text_lower, '[.,!?]', '', 'g') AS cleaned_text
      FROM (SELECT *, lower(text) AS concatenated_text_lower FROM documents)))"""
_tagged = f"WITH {_clean}, tagged AS ({SUBSTRING_SQL})\n"
_bounded = f"WITH {_clean}, tagged AS ({BOUNDED_SQL})\n"

ORACLES = {
    "documents_clean": f"WITH {_clean} SELECT doc_id, cleaned_text, {CLEAN} FROM clean",
    "documents_words": f"WITH {_clean} SELECT doc_id, "
    + ", ".join(f"regexp_extract({CLEAN}, '{p}', 1) AS {n}" for n, p in WORD_PATTERNS.items())
    + " FROM clean",
    "documents_tags": _tagged + f"SELECT doc_id, {', '.join(rules.SUBSTRING_TAGS)} FROM tagged",
    "documents_category": f"WITH {_clean} SELECT category, count(*) AS documents "
    f"FROM (SELECT {_category_sql()} FROM clean) GROUP BY category",
    "documents_coverage": _tagged + _coverage_sql(rules.SUBSTRING_TAGS),
    "documents_bounded_coverage": _bounded + _coverage_sql(rules.BOUNDED_TAGS),
}
