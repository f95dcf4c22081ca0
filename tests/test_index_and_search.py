import inspect
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan
from shelfmark.operators import cells
from shelfmark.operators import index as ix
from shelfmark.operators import similarity
from registered import stand_ins
from registered.stand_ins import hashed_words
from shelfmark.operators.embedding import with_embedding
from shelfmark.operators.similarity import best_matches
from shelfmark.plans.search import search
from shelfmark.sources.tables import use_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = "site_product_identifier string, concatenated_text string"


def embedder():
    return hashed_words(16)


def products(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_embedding_is_unit_length_and_null_for_null(spark):
    df = products(spark, [("1", "a b b"), ("2", None), ("3", "")])
    rows = {r[0]: r.embedding for r in with_embedding(df, embedder).collect()}
    assert rows["2"] is None
    assert abs(np.linalg.norm(rows["1"]) - 1) < 1e-6
    assert rows["3"] == [0.0] * 16


def test_texts_are_embedded_once_when_searched_at_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting():
        inner = hashed_words(16)

        def embed(texts):
            seen.add(len(texts))
            return inner(texts)

        return embed

    df = with_embedding(products(spark, [(str(i), f"w{i}") for i in range(30)]), counting)
    assert best_matches(df, query_table(spark, [[1.0] * 16])).count() == 3
    assert seen.value == 30


OLD = [("same", "x"), ("gone", "x"), ("changed", "x"), ("emptied", "x"), (None, "x"), ("unborn", None)]
NEW = [("same", "x"), ("changed", "y"), ("emptied", None), ("new", "z"), (None, "y"), ("unborn", None)]


def test_changes(spark):
    index = ix.embedded(products(spark, OLD), embedder)
    got = {r[0]: r.change for r in ix.index_changes(products(spark, NEW), index).collect()}
    assert got == {"gone": "delete", "changed": "update", "emptied": "delete", "new": "insert"}


def test_sync_creates_then_embeds_only_what_changed(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_index", str(tmp_path / "i"))
    seen = spark.sparkContext.accumulator(0)

    def counting():
        inner = hashed_words(16)

        def embed(texts):
            seen.add(len(texts))
            return inner(texts)

        return embed

    try:
        first = ix.sync_index(products(spark, OLD), "idx", counting, buckets=2)
        assert {r.change for r in first.collect()} == {"insert"} and seen.value == 4
        second = ix.sync_index(products(spark, NEW), "idx", counting, buckets=2)
        assert second.count() == 4 and seen.value == 6
        keys = {r[0] for r in spark.table("idx").collect()}
        assert keys == {"same", "changed", "new"}
        assert ix.sync_index(products(spark, NEW), "idx", counting, buckets=2).count() == 0
        assert seen.value == 6
        fresh = {r[0]: r.embedding for r in ix.embedded(products(spark, NEW), embedder).collect()}
        assert {r[0]: r.embedding for r in spark.table("idx").collect()} == fresh
        for _ in range(3):
            ix.sync_index(products(spark, NEW), "idx", counting, buckets=2)
        assert len(spark.table("idx").inputFiles()) <= 4
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_index CASCADE")


def test_copies_of_a_key_do_not_multiply(spark):
    rows = [("hot", "x")] * 500 + [("hot", "y")] * 500 + [("cold", "z")]
    source = products(spark, rows).repartition(4)
    empty = ix.embedded(products(spark, []), embedder)
    changes = ix.index_changes(source, empty)
    assert sorted(r[0] for r in changes.collect()) == ["cold", "hot"]
    assert sorted(r[0] for r in ix.refreshed(source, empty, changes, embedder).collect()) == ["cold", "hot"]
    text = plan(changes)
    assert "partial_max" in text[text.index("Exchange"):]


def corpus(spark, n=400, dim=8, seed=1, ids=str):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim)).round(2)
    vectors[n // 2 : n // 2 + n // 3] = vectors[0]  # a third of all rows alike
    rows = [(ids(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    kind = "string" if ids is str else "bigint"
    return spark.createDataFrame(rows, f"site_product_identifier {kind}, embedding array<float>"), vectors


def brute(vectors, queries, k, ids=str):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(queries) @ unit(np.float32(vectors).astype(float)).T, 9)
    return {
        (q, rank + 1, key)
        for q, row in enumerate(scores)
        for rank, (_, key) in enumerate(sorted((-s, ids(i)) for i, s in enumerate(row))[:k])
    }


def query_table(spark, queries):
    rows = [(i, [float(x) for x in q]) for i, q in enumerate(queries)]
    return spark.createDataFrame(rows, "query_id int, embedding array<double>")


def triples(df, key="site_product_identifier"):
    return {(r.query_id, r["rank"], r[key]) for r in df.collect()}


@pytest.mark.parametrize("ids", [str, int])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_equals_brute_force_with_many_ties(spark, ids, k):
    df, vectors = corpus(spark, ids=ids)
    queries = np.vstack([vectors[0], vectors[3], np.ones(8), -vectors[0]])
    got = triples(best_matches(df.repartition(7), query_table(spark, queries), k))
    assert got == brute(vectors, queries, k, ids)


def test_small_blocks_give_the_same(spark, monkeypatch):
    df, vectors = corpus(spark)
    queries = vectors[:7]
    whole = triples(best_matches(df, query_table(spark, queries)))
    monkeypatch.setattr(similarity, "QUERIES", 2)
    monkeypatch.setattr(similarity, "ROWS", 30)
    monkeypatch.setattr(similarity, "SCORES", 50)
    assert triples(best_matches(df, query_table(spark, queries))) == whole == brute(vectors, queries, 3)


def test_zero_null_and_broken_vectors(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), (None, [1.0, 0.0]), ("d", [None, 1.0]), ("e", [-1.0, 0.0])],
        "site_product_identifier string, embedding array<float>",
    )
    rows = best_matches(df, query_table(spark, [[2.0, 0.0]]), 9).collect()
    assert [(r[2], r.score) for r in rows] == [("a", 1.0), ("b", 0.0), ("d", 0.0), ("e", -1.0)]


def test_no_queries_no_corpus_and_bad_input(spark):
    df, _ = corpus(spark, 20)
    assert best_matches(df, query_table(spark, [])).count() == 0
    assert best_matches(df.limit(0), query_table(spark, [[1.0] * 8])).count() == 0
    with pytest.raises(Exception, match="distinct"):
        best_matches(df, query_table(spark, [[1.0] * 8]).union(query_table(spark, [[2.0] * 8]))).collect()
    with pytest.raises(Exception, match="8|numbers"):
        best_matches(df, query_table(spark, [[1.0] * 5])).collect()


def test_filter_reaches_the_scan(spark, tmp_path):
    df, vectors = corpus(spark)
    df.withColumn("label", F.length("site_product_identifier")).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    found = best_matches(stored, query_table(spark, vectors[:2]), where=F.col("label") == 2)
    text = plan(found)
    assert "EqualTo(label,2)" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert {len(r[2]) for r in found.collect()} == {2}


def clustered(spark, n=3000, dim=8, groups=12):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(groups, dim))
    vectors = (middles[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, dim))).round(3)
    vectors[: n // 3] = vectors[0]
    vectors[n - 1] = 0
    rows = [(str(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "site_product_identifier string, embedding array<float>"), vectors


def written_cells(spark, df, number, tmp_path):
    pivots = cells.choose_pivots(df, number)
    path = str(tmp_path / "cells")
    cells.with_cells(df, pivots).write.partitionBy("cell").parquet(path)
    laid_out = spark.read.parquet(path)
    return laid_out, pivots, cells.cell_bounds(laid_out)


@pytest.mark.parametrize("k", [1, 3, 1200])
def test_search_by_cell_equals_the_whole_search(spark, tmp_path, k):
    df, vectors = clustered(spark)
    laid_out, pivots, bounds = written_cells(spark, df, 40, tmp_path)
    queries = query_table(spark, np.vstack([vectors[0], vectors[2500], -vectors[7], np.ones(8), np.zeros(8)]))
    got = cells.best_matches_by_cell(laid_out, pivots, bounds, queries, k)
    assert triples(got) == triples(best_matches(df, queries, k))


def test_search_by_cell_skips_cells(spark, tmp_path, monkeypatch):
    df, vectors = clustered(spark)
    laid_out, pivots, bounds = written_cells(spark, df, 40, tmp_path)
    sent = []

    def counting(corpus, blocks, *args):
        sent.append(blocks.select("slot").distinct().count())
        return similarity.scored(corpus, blocks, *args)

    monkeypatch.setattr(cells, "scored", counting)
    queries = query_table(spark, vectors[2500:2501])
    got = cells.best_matches_by_cell(laid_out, pivots, bounds, queries, 3)
    assert triples(got) == triples(best_matches(df, queries, 3))
    assert sum(sent) < bounds.count() / 2
    assert "PartitionFilters: [cell" in plan(laid_out.filter(F.col("cell").isin(1, 2)))


def test_a_failed_write_keeps_the_cells(spark, tmp_path):
    df, _ = clustered(spark, 100)
    pivots = cells.choose_pivots(df, 4)
    before = spark.catalog.currentDatabase()
    use_schema(spark, "test_cells", str(tmp_path / "c"))
    try:
        assert cells.write_cells(df, "laid_out", pivots).count() == 100
        boom = df.withColumn("embedding", F.when(F.col("site_product_identifier") == "7", F.raise_error(F.lit("boom")).cast("array<float>")).otherwise(F.col("embedding")))
        with pytest.raises(Exception, match="boom"):
            cells.write_cells(boom, "laid_out", pivots)
        assert spark.table("laid_out").count() == 100
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE test_cells CASCADE")


def test_search_by_cell_with_a_condition(spark, tmp_path):
    df, vectors = clustered(spark, 600)
    laid_out, pivots, bounds = written_cells(spark, df, 20, tmp_path)
    queries = query_table(spark, vectors[100:110])
    some = F.col("site_product_identifier").cast("int") % 7 == 0
    got = cells.best_matches_by_cell(laid_out, pivots, bounds, queries, 5, where=some)
    assert triples(got) == triples(best_matches(df, queries, 5, where=some))


def test_many_queries_by_cell(spark, tmp_path, monkeypatch):
    df, vectors = clustered(spark, 300)
    laid_out, pivots, bounds = written_cells(spark, df, 5, tmp_path)
    monkeypatch.setattr(similarity, "QUERIES", 2)
    monkeypatch.setattr(cells, "SCORES", 7)
    queries = query_table(spark, vectors[100:110])
    got = cells.best_matches_by_cell(laid_out, pivots, bounds, queries)
    assert triples(got) == triples(best_matches(df, queries))


def test_every_text_is_embedded_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counting():
        inner = hashed_words(16)

        def embed(texts):
            seen.add(len(texts))
            return inner(texts)

        return embed

    monkeypatch.setattr(similarity, "QUERIES", 10)
    gold = products(spark, [(str(i), f"word{i % 7} car{i}") for i in range(40)])
    index = ix.embedded(gold, counting)
    texts = spark.createDataFrame([(i, f"word{i}") for i in range(50)], "query_id int, query_text string")
    assert search(index, gold, texts, counting, ["concatenated_text"]).count() == 150
    assert seen.value == 90


def test_text_search_returns_columns_in_rank_order(spark):
    gold = products(spark, [("1", "red brick castle"), ("2", "blue car"), ("3", "red car"), ("4", None)])
    gold = gold.withColumn("product_name", F.upper("concatenated_text")).withColumn("n", F.col(gold.columns[0]).cast("int"))
    index = ix.embedded(gold, lambda: hashed_words(256))
    texts = spark.createDataFrame([(1, "red car"), (2, "castle")], "query_id int, query_text string")
    rows = search(index, gold, texts, lambda: hashed_words(256), ["product_name"], k=2).collect()
    assert [(r.query_id, r["rank"]) for r in rows] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert rows[0].product_name == "RED CAR" and rows[2].product_name == "RED BRICK CASTLE"
    some = search(index, gold, texts, lambda: hashed_words(256), ["product_name"], where=F.col("n") < 3)
    assert {r[2] for r in some.collect()} == {"1", "2"}


def test_many_texts_find_the_same(spark, monkeypatch):
    gold = products(spark, [(str(i), f"word{i % 7} brick{i % 3} car{i}") for i in range(60)])
    index = ix.embedded(gold, embedder)
    texts = spark.createDataFrame(
        [(i, f"word{i} car{i}") for i in range(5)], "query_id int, query_text string"
    )
    once = search(index, gold, texts, embedder, ["concatenated_text"]).collect()
    monkeypatch.setattr(similarity, "QUERIES", 2)
    assert search(index, gold, texts, embedder, ["concatenated_text"]).collect() == once
    assert len(once) == 15


def test_a_source_that_changes_in_between_loses_no_key(spark):
    index = ix.embedded(products(spark, [("a", "x"), ("b", "x"), ("c", "x")]), embedder)
    changes = ix.index_changes(products(spark, [("a", "y"), ("b", "y")]), index)
    later = products(spark, [("a", "z"), ("b", "y")])
    got = {r[0]: r.embedding for r in ix.refreshed(later, index, changes, embedder).collect()}
    old = {r[0]: r.embedding for r in index.collect()}
    assert set(got) == {"a", "b"} and got["a"] == old["a"] and got["b"] != old["b"]


def test_copies_are_dropped_before_the_shuffle_of_a_sync(spark):
    source = products(spark, [("hot", f"x{i % 3}") for i in range(900)] + [("cold", "z")]).repartition(6)
    text = plan(ix.one_per_key(source))
    assert text.index("Exchange hash") < text.rindex("WindowGroupLimit")
    assert ix.one_per_key(source).count() == 2


def test_embedding_in_as_many_tasks_as_asked(spark):
    rows = products(spark, [(str(i), f"w{i}") for i in range(200)])
    out = ix.embedded(ix.one_per_key(rows), embedder, partitions=7)
    assert out.rdd.getNumPartitions() == 7 and out.count() == 200


def test_the_stand_in_remembers_a_bounded_number_of_words(monkeypatch):
    texts = [" ".join(f"word{i * j % 97}" for j in range(30)) for i in range(20)]
    free = hashed_words(16)(texts)
    monkeypatch.setattr(stand_ins, "REMEMBERED", 5)
    bounded = hashed_words(16)
    assert (bounded(texts) == free).all()
    slot = inspect.getclosurevars(bounded).nonlocals["slot"]
    assert len(inspect.getclosurevars(slot).nonlocals["slots"]) <= 5
