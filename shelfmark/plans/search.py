"""Text search over an index, with columns of the gold table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.catalogue import KEY
from ..operators.embedding import Embedder, with_embedding
from ..operators.kept_cells import KeptCells, search_cells
from ..operators.similarity import best_matches
from ..sources.shared import stored

# What a search returns by default.
RESULT_COLUMNS = [
    "product_name", "category_name", "product_description", "play_type", "occasion_type",
    "product_type", "theme_type",
]
RESULTS = 3


def search(
    index: DataFrame | KeptCells,
    gold: DataFrame,
    texts: DataFrame,
    make_embedder: Callable[[], Embedder],
    columns: Sequence[str] = tuple(RESULT_COLUMNS),
    k: int = RESULTS,
    where: Column | None = None,
    key: str = KEY,
    partitions: int | None = None,
    having: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The k best products of each query text, with the asked-for columns.

    An index kept by cell (``open_cells``) is read only where a match can be; any other is scanned
    whole, with the same answer. ``having`` names the values that attributes of a kept index must
    have, and cells without any of them are not read.

    ``texts`` has (query_id, query_text); each text is embedded once, by
    ``partitions`` embedders at a time if given. Scoring
    reads key and vector only; the columns of the matches are joined on
    afterwards, by a join that Spark plans from their real size. ``where`` is a
    condition on gold columns that limits what is searched. The search runs
    when this is called; its matches are stored.
    """
    kept = isinstance(index, KeptCells)
    if having and not kept:
        raise ValueError("only an index kept by cell knows the values of attributes")
    allowed = None if where is None else gold.filter(where).select(key)
    texts = texts if partitions is None else texts.repartition(partitions)
    queries = with_embedding(texts, make_embedder, "query_text")
    if kept:
        found = search_cells(index, queries, k, having=having, only=allowed)
    else:
        found = best_matches(index if allowed is None else index.join(allowed, key, "left_semi"), queries, k, key)
    matches = stored(found, "matches")
    return (
        matches.join(gold.select(key, *columns), key)
        .select("query_id", "rank", key, *columns, "score")
        .orderBy("query_id", "rank")
    )
