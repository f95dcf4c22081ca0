"""Embedding, index upkeep and similarity search.

A vector is compared as the list of its numbers times a million, rounded, as
text: the same in both engines.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from shelfmark.functions.text import with_text
from shelfmark.operators.changes import change_set, composed
from shelfmark.operators.cells import (
    best_matches_by_cell, cell_bounds, choose_pivots, write_cells,
)
from shelfmark.operators.catalogue import deduplicate, is_live, live_products, product_columns
from registered.stand_ins import hashed_words
from shelfmark.operators.kept_cells import open_cells, sync_cells
from shelfmark.operators.pruned import best_matches_of_many
from shelfmark.operators.embedding import with_embedding
from shelfmark.operators.index import embedded, index_changes, refreshed, sync_index
from shelfmark.operators.similarity import best_matches
from shelfmark.plans.regex_gold import regex_gold
from shelfmark.plans.search import RESULT_COLUMNS, search
from shelfmark.sources.shared import fresh_path, stored
from shelfmark.sources.tables import spread, use_schema

from .catalogue import SUBSTRING_SQL
from .inputs import STEPS, raw_catalogue, silver_catalogue, table, with_steps

KEY = "site_product_identifier"
DIM = 64
# The searches the catalogue is asked.
TEXTS = [
    (1, "tiny models of famous places for explorers"),
    (2, "buildable 3-in-1 jungle animal with fruit"),
    (3, "guard the king’s gold in the castle cellar!"),
    (4, "A red widget for Christmas"),
]


def _numbers(column="embedding"):
    scaled = F.transform(column, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint"))
    return F.array_join(scaled.cast("array<string>"), ",")


def embed_text(spark, folder):
    texts = table(spark, folder, "documents").select("doc_id", "text")
    vectors = with_embedding(spread(texts, "doc_id"), _embedder, "text")
    return vectors.select("doc_id", _numbers().alias("numbers"))


def old_source(spark, folder):
    """The catalogue before: retired products still listed, no headlines."""
    raw = raw_catalogue(spark, folder).filter("availability_status IS NOT NULL")
    rows = deduplicate(product_columns(raw, ["p_partkey"]), KEY, ["p_partkey"])
    return with_text(rows.withColumn("headline_text", F.lit("New")))


def new_source(spark, folder):
    """The catalogue after: retired products gone, others arrived, headlines known for most."""
    raw = raw_catalogue(spark, folder).filter(is_live() | F.col("availability_status").isNull())
    rows = deduplicate(product_columns(raw, ["p_partkey"]), KEY, ["p_partkey"])
    known = F.when(F.col("category_name") == "PROMO", F.col("headline_text")).otherwise("New")
    return with_text(rows.withColumn("headline_text", known))


def _embedder():
    return hashed_words(DIM)


def index_diff(spark, folder):
    index = embedded(old_source(spark, folder), _embedder)
    return index_changes(new_source(spark, folder), index).select(KEY, "change")


def _spring_source(spark, folder):
    """A version in between: some kinds are gone, others have a headline of their own."""
    raw = raw_catalogue(spark, folder).filter("category_name NOT LIKE '%BRASS'")
    rows = deduplicate(product_columns(raw, ["p_partkey"]), KEY, ["p_partkey"])
    headline = F.when(F.col("category_name").like("PROMO%"), "Spring").otherwise("New")
    return with_text(rows.withColumn("headline_text", headline))


def changes_composed(spark, folder):
    """The changes over three versions, put together from those between neighbours."""
    versions = [old_source(spark, folder), _spring_source(spark, folder), new_source(spark, folder)]
    sets = [stored(change_set(a, b), "change-set") for a, b in zip(versions, versions[1:])]
    return composed(sets).select(KEY, "change")


def index_refresh(spark, folder):
    """The old index brought up to date equals an index of the new source."""
    index = stored(embedded(old_source(spark, folder), _embedder), "index")
    source = new_source(spark, folder)
    changes = stored(index_changes(source, index), "index-changes")
    return refreshed(source, index, changes, _embedder).select(KEY, _numbers().alias("numbers"))


def index_sync(spark, folder):
    """The same through a table: created from the old source, synced to the new one."""
    before = spark.catalog.currentDatabase()
    try:
        use_schema(spark, f"shop_{uuid4().hex}", fresh_path(spark, "schema"))
        sync_index(old_source(spark, folder), "product_index", _embedder, buckets=8)
        sync_index(new_source(spark, folder), "product_index", _embedder, buckets=8)
        return spark.table("product_index").select(KEY, _numbers().alias("numbers"))
    finally:
        spark.catalog.setCurrentDatabase(before)


def index_parts(spark, folder):
    """The same, of which a sync writes only the parts with changes."""
    before = spark.catalog.currentDatabase()
    try:
        use_schema(spark, f"shop_{uuid4().hex}", fresh_path(spark, "schema"))
        sync_index(old_source(spark, folder), "product_index", _embedder, parts=64)
        sync_index(new_source(spark, folder), "product_index", _embedder, parts=64)
        return spark.table("product_index").select(KEY, _numbers().alias("numbers"))
    finally:
        spark.catalog.setCurrentDatabase(before)


def _summed(vectors, query_id):
    """One query per value of ``query_id``: the exact sum of its vectors."""
    parts = vectors.select(
        query_id.alias("query_id"),
        F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"),
    )
    exact = F.sum(F.round("x", 6).cast("decimal(20,6)")).alias("x")
    sums = parts.groupBy("query_id", "i").agg(exact)
    lists = sums.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("l"))
    return lists.select(
        "query_id", F.transform("l", lambda e: e["x"].cast("double")).alias("embedding")
    )


def search_topk(spark, folder):
    """What lies nearest to the middle of all vectors."""
    vectors = table(spark, folder, "embeddings")
    return best_matches(vectors, _summed(vectors, F.lit(1)), 3, "vec_id")


def search_many(spark, folder):
    """What lies nearest to the middle of each label."""
    vectors = table(spark, folder, "embeddings")
    return best_matches(vectors, _summed(vectors, F.col("label")), 5, "vec_id")


def search_filtered(spark, folder):
    """The same, among the vectors of some labels."""
    vectors = table(spark, folder, "embeddings")
    queries = _summed(vectors, F.col("label"))
    return best_matches(vectors, queries, 3, "vec_id", where=F.col("label").isin(1, 4, 7))


def search_cells(spark, folder):
    """The nearest to the middle of each label again, from a table laid out by cell."""
    vectors = table(spark, folder, "embeddings")
    pivots = choose_pivots(vectors, 16, "vec_id")
    name = f"cells_{uuid4().hex}"
    cells = write_cells(vectors, name, pivots, "vec_id", path=fresh_path(spark, "cells"))
    bounds = stored(cell_bounds(cells), "cell-bounds")
    queries = _summed(vectors, F.col("label"))
    return best_matches_by_cell(cells, pivots, bounds, queries, 5, "vec_id")


def search_documents(spark, folder):
    """The documents nearest to each benchmark passage."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    index = stored(with_embedding(spread(documents, "doc_id"), _embedder, "text"), "index")
    passages = table(spark, folder, "benchmark")
    queries = with_embedding(passages, _embedder, "text")
    return best_matches(index, queries, 3, "doc_id", query_key="item_id")


def search_many_queries(spark, folder):
    """The documents nearest to the words of each event: more queries than documents."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    index = stored(with_embedding(spread(documents, "doc_id"), _embedder, "text"), "index")
    events = table(spark, folder, "events").selectExpr("event_id", "concat(event_type, ' ', props) AS words")
    queries = with_embedding(spread(events, "event_id"), _embedder, "words")
    return best_matches_of_many(index, queries, 2, "doc_id", query_key="event_id")


def search_neighbours(spark, folder):
    """The vectors nearest to each vector, among themselves: as many queries as rows."""
    vectors = table(spark, folder, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return best_matches_of_many(vectors, queries, 4, "vec_id", cell_rows=256)


def _texts(spark):
    return spark.createDataFrame(TEXTS, "query_id int, query_text string")


def search_text(spark, folder):
    gold = stored(regex_gold(silver_catalogue(spark, folder)), "gold")
    index = stored(embedded(gold, _embedder), "index")
    return search(index, gold, _texts(spark), _embedder)


def search_text_filtered(spark, folder):
    gold = stored(regex_gold(silver_catalogue(spark, folder)), "gold")
    index = stored(embedded(gold, _embedder), "index")
    columns = ["product_name", "age_range"]
    return search(index, gold, _texts(spark), _embedder, columns, where=F.col("age_range") == "kids")


def _kept(spark, folder):
    """Gold and its index by cell: created from the catalogue before, then synced to the present one."""
    gold = stored(regex_gold(silver_catalogue(spark, folder)), "gold")
    past = old_source(spark, folder).withColumn("age_range", F.lit("kids"))
    sync_cells(past, "product_cells", _embedder, attributes=["age_range"], cell_rows=256)
    sync_cells(gold, "product_cells", _embedder, attributes=["age_range"], cell_rows=256)
    return gold, open_cells(spark, "product_cells")


def search_kept_cells(spark, folder):
    """The searches again, over an index kept by cell."""
    before = spark.catalog.currentDatabase()
    try:
        use_schema(spark, f"shop_{uuid4().hex}", fresh_path(spark, "schema"))
        gold, kept = _kept(spark, folder)
        return search(kept, gold, _texts(spark), _embedder)
    finally:
        spark.catalog.setCurrentDatabase(before)


def search_kept_filtered(spark, folder):
    """Among products for kids only: cells without any are not read."""
    before = spark.catalog.currentDatabase()
    try:
        use_schema(spark, f"shop_{uuid4().hex}", fresh_path(spark, "schema"))
        gold, kept = _kept(spark, folder)
        columns = ["product_name", "age_range"]
        return search(kept, gold, _texts(spark), _embedder, columns, having={"age_range": ["kids"]})
    finally:
        spark.catalog.setCurrentDatabase(before)


QUERIES = {
    "embed_text": embed_text,
    "index_diff": index_diff,
    "changes_composed": changes_composed,
    "index_refresh": index_refresh,
    "index_sync": index_sync,
    "index_parts": index_parts,
    "search_topk": search_topk,
    "search_many": search_many,
    "search_filtered": search_filtered,
    "search_cells": search_cells,
    "search_documents": search_documents,
    "search_many_queries": search_many_queries,
    "search_text": search_text,
    "search_text_filtered": search_text_filtered,
    "search_neighbours": search_neighbours,
    "search_kept_cells": search_kept_cells,
    "search_kept_filtered": search_kept_filtered,
}


def _embed_steps(source: str, key: str, text: str) -> dict[str, str]:
    """Hashed word counts of unit length: vectors AS (key, embedding float[])."""
    return {
        "words": f"""
SELECT {key} AS id, word FROM (
  SELECT {key}, unnest(string_split_regex(lower({text}), '[ \\n]+')) AS word FROM {source}
  WHERE {text} IS NOT NULL) WHERE word <> ''""",
        "slots": f"""
SELECT id, slot, count(*) AS n FROM (
  SELECT id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {DIM} AS slot FROM words)
GROUP BY id, slot""",
        "lengths": "SELECT id, sqrt(sum(n * n)) AS length FROM slots GROUP BY id",
        "vectors": f"""
SELECT ids.{key} AS id,
       list(CAST(coalesce(n / length, 0) AS FLOAT) ORDER BY i) AS embedding
FROM (SELECT {key} FROM {source} WHERE {text} IS NOT NULL) AS ids
CROSS JOIN range({DIM}) AS r(i)
LEFT JOIN slots ON slots.id = ids.{key} AND slot = i
LEFT JOIN lengths ON lengths.id = ids.{key}
GROUP BY ids.{key}""",
    }


def _numbers_sql(column="embedding"):
    return (
        f"array_to_string(list_transform({column}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000)"
        " AS BIGINT)), ',')"
    )


def _with(steps: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items()) + "\n" + body


def _source_sql(condition: str, headline: str) -> str:
    return f"""
SELECT site_product_identifier, {headline} || ' | ' || product_name || ' | '
       || product_description || ' | ' || category_name || ' | ' || site_product_identifier AS text
FROM (SELECT *, row_number() OVER (PARTITION BY site_product_identifier ORDER BY p_partkey) AS n
      FROM catalogue WHERE {condition}) WHERE n = 1"""


_sources = {
    "catalogue": STEPS["catalogue"],
    "old_source": _source_sql("availability_status IS NOT NULL", "'New'"),
    "new_source": _source_sql(
        "availability_status <> 'R_RETIRED' OR availability_status IS NULL",
        "CASE WHEN category_name = 'PROMO' THEN headline_text ELSE 'New' END",
    ),
}
_synced = _with(
    _sources | _embed_steps("new_source", KEY, "text"),
    f"SELECT id AS {KEY}, {_numbers_sql()} AS numbers FROM vectors",
)


def _topk_sql(corpus: str, queries: str, key: str, k: int) -> str:
    """Brute force over (key, embedding) and (query_id, embedding)."""
    return f"""
SELECT query_id, rank, {key}, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS rank
  FROM (SELECT q.query_id, c.{key},
          coalesce(round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                                                CAST(c.embedding AS DOUBLE[])), 9), 0) AS score
        FROM ({corpus}) AS c CROSS JOIN ({queries}) AS q))
WHERE rank <= {k}"""


_all = "SELECT vec_id, embedding FROM embeddings"


def _summed_sql(query_id: str) -> str:
    return f"""
SELECT query_id, list(CAST(x AS DOUBLE) ORDER BY i) AS embedding
FROM (SELECT query_id, i, sum(CAST(round(x, 6) AS DECIMAL(20, 6))) AS x
      FROM (SELECT {query_id} AS query_id, unnest(CAST(embedding AS DOUBLE[])) AS x,
                   generate_subscripts(embedding, 1) AS i FROM embeddings)
      GROUP BY query_id, i) GROUP BY query_id"""


_rank = "CAST(rank AS INTEGER) AS rank"


def _ranked_sql(corpus: str, queries: str, key: str, k: int) -> str:
    return f"SELECT query_id, {_rank}, {key}, score FROM ({_topk_sql(corpus, queries, key, k)})"


_texts_sql = " UNION ALL ".join(
    f"SELECT {number} AS query_id, '{text}' AS query_text" for number, text in TEXTS
)


def _query_steps(source: str, key: str, text: str) -> dict[str, str]:
    """The steps of an embedding again, under names of their own."""
    steps = _embed_steps(source, key, text)
    renamed = {}
    for name, sql in steps.items():
        for step in steps:
            sql = sql.replace(f"FROM {step}", f"FROM query_{step}").replace(
                f"JOIN {step} ON {step}.id", f"JOIN query_{step} AS {step} ON {step}.id"
            )
        renamed[f"query_{name}"] = sql
    return renamed


def _text_search_sql(columns: list[str], where: str) -> str:
    names = [name for name in STEPS]
    steps = {name: STEPS[name] for name in names} | {"tagged": SUBSTRING_SQL}
    corpus = _embed_steps("tagged", KEY, "concatenated_text")
    steps |= corpus
    steps |= {"texts": _texts_sql} | _query_steps("texts", "query_id", "query_text")
    steps["matches"] = _topk_sql(
        f"SELECT id AS {KEY}, embedding FROM vectors "
        f"WHERE id IN (SELECT {KEY} FROM tagged WHERE {where})",
        "SELECT id AS query_id, embedding FROM query_vectors",
        KEY,
        3,
    )
    return _with(
        steps,
        f"SELECT query_id, {_rank}, {KEY}, {', '.join(columns)}, score "
        f"FROM matches JOIN tagged USING ({KEY})",
    )


ORACLES = {
    "embed_text": _with(
        _embed_steps("documents", "doc_id", "text"),
        f"SELECT id AS doc_id, {_numbers_sql()} AS numbers FROM vectors",
    ),
    "index_diff": _with(
        _sources,
        f"""
SELECT coalesce(o.{KEY}, n.{KEY}) AS {KEY},
       CASE WHEN o.text IS NULL THEN 'insert' WHEN n.text IS NULL THEN 'delete'
            ELSE 'update' END AS change
FROM (SELECT * FROM old_source WHERE text IS NOT NULL) AS o
FULL JOIN (SELECT * FROM new_source WHERE text IS NOT NULL) AS n ON o.{KEY} = n.{KEY}
WHERE o.text IS DISTINCT FROM n.text""",
    ),
    "index_refresh": _synced,
    "index_sync": _synced,
    "search_topk": _ranked_sql(_all, _summed_sql("1"), "vec_id", 3),
    "search_many": _ranked_sql(_all, _summed_sql("label"), "vec_id", 5),
    "search_filtered": _ranked_sql(
        _all + " WHERE label IN (1, 4, 7)", _summed_sql("label"), "vec_id", 3
    ),
    "search_cells": _ranked_sql(_all, _summed_sql("label"), "vec_id", 5),
    "search_documents": _with(
        _embed_steps("documents", "doc_id", "text") | _query_steps("benchmark", "item_id", "text"),
        f"SELECT query_id AS item_id, {_rank}, doc_id, score FROM ("
        + _topk_sql(
            "SELECT id AS doc_id, embedding FROM vectors",
            "SELECT id AS query_id, embedding FROM query_vectors",
            "doc_id",
            3,
        )
        + ")",
    ),
    "search_many_queries": _with(
        {"asked": "SELECT event_id, event_type || ' ' || props AS words FROM events"}
        | _embed_steps("documents", "doc_id", "text") | _query_steps("asked", "event_id", "words"),
        f"SELECT query_id AS event_id, {_rank}, doc_id, score FROM ("
        + _topk_sql(
            "SELECT id AS doc_id, embedding FROM vectors",
            "SELECT id AS query_id, embedding FROM query_vectors",
            "doc_id",
            2,
        )
        + ")",
    ),
    "search_neighbours": _ranked_sql(_all, "SELECT vec_id AS query_id, embedding FROM embeddings", "vec_id", 4),
    "search_text": _text_search_sql(RESULT_COLUMNS, "true"),
    "search_text_filtered": _text_search_sql(["product_name", "age_range"], "age_range = 'kids'"),
}
ORACLES["index_parts"] = ORACLES["index_sync"]
ORACLES["search_kept_cells"] = ORACLES["search_text"]
ORACLES["search_kept_filtered"] = ORACLES["search_text_filtered"]
# The changes from the first version to the last, found directly.
ORACLES["changes_composed"] = ORACLES["index_diff"]
