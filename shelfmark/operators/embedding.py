"""Embedding of a text column with a caller's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[list[str]], np.ndarray]


def with_embedding(
    df: DataFrame,
    make_embedder: Callable[[], Embedder],
    text: str = "concatenated_text",
    out: str = "embedding",
    batch: int = 256,
) -> DataFrame:
    """Add a float vector per text; a NULL text gets a NULL vector.

    ``make_embedder`` runs once per partition. Only the text goes to Python and
    only the vector comes back.
    """

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = make_embedder()
        for texts in batches:
            known = texts[texts.notna()]
            got: list[np.ndarray] = []
            for start in range(0, len(known), batch):
                part = known.iloc[start : start + batch]
                got.extend(np.asarray(embed(part.tolist()), dtype=np.float32))
            if len(got) != len(known):
                raise ValueError(f"embedder gave {len(got)} vectors for {len(known)} texts")
            column = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            for row, vector in zip(known.index, got):
                column[row] = vector
            yield column

    # Nondeterministic to the optimizer: a filter on the vector must not be
    # moved below it, which would embed each text a second time.
    return df.withColumn(out, vectors.asNondeterministic()(F.col(text)))
