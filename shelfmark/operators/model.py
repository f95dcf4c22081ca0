"""Batch tagging with a caller's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


class Request(NamedTuple):
    """One call of a tagging model: the rendered prompt and the text it is about."""

    system: str
    question: str
    description: str


Model = Callable[[list[Request]], list[str]]


def with_model_tags(
    df: DataFrame,
    make_model: Callable[[dict], Model],
    text: str = "concatenated_text",
    out: str = "tagged_description",
    template: str = rules.MODEL_PROMPT,
    question: str = rules.MODEL_QUESTION,
    settings: dict | None = None,
    partitions: int | None = None,
    batch: int = 64,
) -> DataFrame:
    """Add the model's answer to each text; a NULL text gets NULL and costs no call.

    ``make_model`` gets the sampling settings and runs once per partition, so
    clients and loaded weights are shared by all its rows. Only the text column
    goes to Python. ``partitions`` sets how many calls run at a time; leave it
    out to keep the input's partitions and save the shuffle. Answers may differ
    from call to call: write the result to a table before using it twice.
    """
    settings = dict(rules.MODEL_SETTINGS if settings is None else settings)
    slot = rules.DESCRIPTION_SLOT

    @F.pandas_udf("string")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model(settings)
        for texts in batches:
            known = texts[texts.notna()]
            got: list[str] = []
            for start in range(0, len(known), batch):
                part = known.iloc[start : start + batch]
                got.extend(model([Request(template.replace(slot, t), question, t) for t in part]))
            if len(got) != len(known):
                raise ValueError(f"model gave {len(got)} answers to {len(known)} requests")
            yield pd.Series(got, index=known.index, dtype=object).reindex(texts.index)

    if partitions is not None:
        df = df.repartition(partitions)
    return df.withColumn(out, answers.asNondeterministic()(F.col(text)))
