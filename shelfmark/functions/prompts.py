"""Rendering of model requests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules


def system_prompt(description: Column, template: str = rules.MODEL_PROMPT) -> Column:
    return F.replace(F.lit(template), F.lit(rules.DESCRIPTION_SLOT), description)


def with_prompt(
    df: DataFrame,
    text: str = "concatenated_text",
    template: str = rules.MODEL_PROMPT,
    question: str = rules.MODEL_QUESTION,
) -> DataFrame:
    """Add the system and the user part of the request."""
    return df.withColumns(
        {"system_prompt": system_prompt(F.col(text), template), "user_prompt": F.lit(question)}
    )
