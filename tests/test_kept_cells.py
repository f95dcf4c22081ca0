import os
import sys
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan
from registered.stand_ins import hashed_words
from shelfmark.operators import index as ix
from shelfmark.operators import kept_cells as kc
from shelfmark.operators import pruned, similarity
from shelfmark.operators.similarity import best_matches
from shelfmark.sources import pieces
from shelfmark.sources.tables import use_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "site_product_identifier"
COLUMNS = f"{KEY} string, concatenated_text string, age string, `play type` string, size int"


@contextmanager
def schema_in(spark, folder):
    before = spark.catalog.currentDatabase()
    name = f"kept_{uuid4().hex}"
    use_schema(spark, name, str(folder / "s"))
    yield str(folder / "s")
    spark.catalog.setCurrentDatabase(before)
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def schema(spark, tmp_path):
    with schema_in(spark, tmp_path) as folder:
        yield folder


def embedder():
    return hashed_words(16)


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    def make():
        inner = hashed_words(16)

        def embed(texts):
            seen.add(len(texts))
            return inner(texts)

        return embed

    return seen, make


def failing():
    def embed(texts):
        raise RuntimeError("no model")

    return embed


def products(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], COLUMNS).repartition(4)


def words(i):
    return f"w{i % 13} x{i % 7} y{i % 5} z{i}"


def catalogue(n, start=0):
    ages = ["kids", "adults", None]
    return [(f"p{i}", words(i), ages[i % 3], "a" if i % 2 else "b, c", i % 4) for i in range(start, n)]


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def triples(df, key=KEY):
    return {(r.query_id, r["rank"], r[key], r.score) for r in df.collect()}


def query_table(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id int, embedding array<double>")


# Partial index sync.


def test_parts_follow_the_source(spark, schema):
    seen, make = counting(spark)
    old, new = catalogue(60), catalogue(58, 2)[:-1] + [("p57", "other", None, None, 1), ("new", "text", None, None, 2)]
    assert ix.sync_index(products(spark, old + [(None, "x")]), "idx", make, parts=16).count() == 60
    assert seen.value == 60
    changes = {tuple(r) for r in ix.sync_index(products(spark, new), "idx", make, parts=16).collect()}
    assert changes == {("p0", "delete"), ("p1", "delete"), ("p58", "delete"), ("p59", "delete"), ("p57", "update"), ("new", "insert")}
    assert seen.value == 62
    want = {r[0]: r.embedding for r in ix.embedded(products(spark, new), embedder).collect()}
    assert {r[0]: r.embedding for r in spark.table("idx").collect()} == want
    assert ix.sync_index(products(spark, new), "idx", make, parts=16).count() == 0 and seen.value == 62
    assert ix.sync_index(products(spark, []), "idx", make, parts=16).count() == len(new)
    assert spark.table("idx").count() == 0
    assert ix.sync_index(products(spark, new), "idx", make, parts=16).count() == len(new)
    assert {r[0]: r.embedding for r in spark.table("idx").collect()} == want
    with pytest.raises(ValueError, match="16 parts"):
        ix.sync_index(products(spark, new), "idx", make, parts=8)


def test_bytes_written_follow_the_changes(spark, schema):
    many = catalogue(2000)
    ix.sync_index(products(spark, many), "idx", embedder, parts=64)
    folder = f"{schema}/idx__rows"
    whole, there = size_of(folder), set(os.listdir(folder))
    many[5] = ("p5", "other words")
    ix.sync_index(products(spark, many), "idx", embedder, parts=64)
    new = set(os.listdir(folder)) - there
    assert len([n for n in new if n.startswith("piece=")]) == 1
    assert sum(size_of(f"{folder}/{n}") for n in new) < whole / 20
    for i in range(3):
        many[i] = (f"p{i}", f"again {i}")
        ix.sync_index(products(spark, many), "idx", embedder, parts=64)
    assert len([n for n in os.listdir(folder) if n.startswith("piece=")]) <= 66


@pytest.mark.parametrize("parts", [None, 8])
def test_a_failed_sync_keeps_the_rows(spark, schema, parts):
    def sync(rows, make):
        if parts:
            return ix.sync_index(products(spark, rows), "idx", make, parts=parts)
        return kc.sync_cells(products(spark, rows), "idx", make, cell_rows=20)

    old, new = catalogue(50), catalogue(60, 10)
    sync(old, embedder)
    with pytest.raises(Exception, match="no model"):
        sync(new, failing)
    assert {r[0] for r in spark.table("idx").collect()} == {f"p{i}" for i in range(50)}
    # Rows that were added but never listed do not count, and the next sync drops them.
    rows = spark.table("idx__rows").limit(5).withColumn(pieces.PIECE, F.lit(9999))
    pieces.add_rows(rows, "idx")
    assert spark.table("idx").count() == 50
    sync(new, embedder)
    assert {r[0] for r in spark.table("idx").collect()} == {f"p{i}" for i in range(10, 60)}
    assert not spark.table("idx__rows").where("piece = 9999").count()


def test_untouched_parts_are_not_read(spark, schema):
    ix.sync_index(products(spark, catalogue(50)), "idx", embedder, parts=8)
    listed = pieces.pieces(spark, "idx")
    one = pieces.rows_in(spark, "idx", listed.where("part = 3"))
    text = plan(one)
    assert "dynamicpruning" in text and "CartesianProduct" not in text
    assert 0 < one.count() < 50


# The kept cells.


def state(spark, name):
    kept = kc.open_cells(spark, name)
    rows = spark.table(name).collect()
    cells = {r.cell: r for r in kept.cells.collect()}
    live = pieces.rows_in(spark, name).collect()
    assert sorted(r[KEY] for r in live) == sorted(r[KEY] for r in rows) and len({r[KEY] for r in rows}) == len(rows)
    held = {}
    for r in live:
        held.setdefault(r.piece, []).append(np.array(r.embedding))
    assert {c: r.rows for c, r in cells.items()} == {c: len(v) for c, v in held.items()}
    for c, vectors in held.items():
        lengths = np.linalg.norm(vectors, axis=1)
        near = np.array(vectors) @ np.array(cells[c].pivot) / np.where(lengths > 0, lengths, 1)
        assert abs(near.min() - cells[c].least_near) < 1e-9
    return rows, cells


def test_cells_follow_the_source(spark, schema):
    seen, make = counting(spark)
    names = ["age", "play type"]
    old = catalogue(300) + [("p5", words(5), "kids", "a", 1)]  # a copy of a key
    sync = lambda rows: {
        tuple(r) for r in kc.sync_cells(products(spark, rows), "idx", make, attributes=names, cell_rows=40).collect()
    }
    assert len(sync(old)) == 300 and seen.value == 300
    rows, cells = state(spark, "idx")
    assert len(rows) == 300 and max(r.rows for r in cells.values()) <= 40
    new = catalogue(320)[10:]
    new[0] = ("p10", "quite other words", "kids", "a", 1)
    new[1] = ("p11", words(11), "teens", "a", 1)
    new[2] = ("p12", None, "kids", "a", 1)
    changes = sync(new)
    kinds = [c for _, c in changes]
    assert {k: kinds.count(k) for k in set(kinds)} == {"delete": 11, "insert": 20, "update": 1, "relabel": 1}
    assert seen.value == 321
    rows, cells = state(spark, "idx")
    assert max(r.rows for r in cells.values()) <= 40
    want = {r[0]: r.embedding for r in ix.embedded(products(spark, new), embedder).collect()}
    assert {r[KEY]: r.embedding for r in rows} == want
    assert {r[KEY]: (r.age, r["play type"]) for r in rows} == {r[0]: r[2:4] for r in new if r[1]}
    assert not sync(new) and seen.value == 321
    with pytest.raises(ValueError, match="attributes"):
        kc.sync_cells(products(spark, new), "idx", make, attributes=["age"])
    assert len(sync([])) == 309 and spark.table("idx").count() == 0 and not state(spark, "idx")[1]
    assert kc.search_cells(kc.open_cells(spark, "idx"), query_table(spark, np.ones((2, 16)))).count() == 0
    assert len(sync(old)) == 300 and len(state(spark, "idx")[0]) == 300


def test_few_changes_write_few_cells(spark, schema):
    rows = catalogue(600)
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=30)
    before = {r.cell for r in kc.open_cells(spark, "idx").cells.collect()}
    rows[7] = ("p7", "other words", None, None, None)
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=30)
    after = {r.cell for r in kc.open_cells(spark, "idx").cells.collect()}
    assert len(before) >= 20 and 0 < len(after - before) <= 4 and len(before - after) <= 2
    state(spark, "idx")


def test_copies_of_one_vector_are_split(spark, schema):
    rows = [(f"p{i}", "the same words") for i in range(200)] + [("q", "others")] + [("e", "")]
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=40)
    _, cells = state(spark, "idx")
    assert max(r.rows for r in cells.values()) <= 40


def steps_of(monkeypatch):
    """The labels of what a sync stores."""
    labels, inner = [], kc.stored
    monkeypatch.setattr(kc, "stored", lambda df, label, by=None: labels.append(label) or inner(df, label, by))
    return labels


def folders(schema):
    return [n for n in os.listdir(f"{schema}/idx__rows") if "=" in n]


def test_steps_do_not_follow_the_cuts(spark, schema, monkeypatch):
    kc.sync_cells(products(spark, [("q", "others")]), "idx", embedder, cell_rows=4)
    labels = steps_of(monkeypatch)
    kc.sync_cells(products(spark, catalogue(250) + [("q", "others")]), "idx", embedder, cell_rows=4)
    _, cells = state(spark, "idx")
    assert len(cells) > 60 and max(r.rows for r in cells.values()) <= 4
    assert labels.count("cells-large") == 1 and "centres" not in labels


def test_cells_too_large_for_a_task(spark, schema, monkeypatch):
    monkeypatch.setattr(kc, "NUMBERS", 16 * 120)
    kc.sync_cells(products(spark, [("q", "others")]), "idx", embedder, cell_rows=15)
    labels = steps_of(monkeypatch)
    rows = catalogue(150) + [(f"c{i}", "the same words") for i in range(100)] + [("e", ""), ("q", "others")]
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=15)
    found, cells = state(spark, "idx")
    assert len(found) == 252 and max(r.rows for r in cells.values()) <= 15 and "centres" in labels
    frame = ix.embedded(products(spark, rows), embedder)
    asked = query_table(spark, [r.embedding for r in found[:20]])
    assert triples(kc.search_cells(kc.open_cells(spark, "idx"), asked, 5)) == triples(best_matches(frame, asked, 5))


@pytest.mark.parametrize("kind", ["spread", "copies", "zeros", "outliers"])
def test_parts_of_a_cell(kind):
    vectors = np.random.default_rng(1).normal(size=(500, 6))
    if kind == "copies":
        vectors[20:] = vectors[20]
    elif kind == "zeros":
        vectors[3:] = 0
    elif kind == "outliers":  # each would be alone on its side of a cut
        vectors = np.eye(500)[:, :6] * 9 + 1e-3 * vectors
    chance = np.random.default_rng(2).permutation(500)
    part, pivots = kc._parts(similarity.unit(vectors), chance, 7)
    sizes = np.bincount(part)
    assert sizes.min() > 0 and sizes.max() <= 7 and len(sizes) == len(pivots) < 500
    assert {part[i] for i in pivots} == set(range(len(sizes)))


def test_small_cells_share_a_folder(spark, schema):
    rows = catalogue(600)
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=30)
    assert len(kc.open_cells(spark, "idx").cells.collect()) >= 20 and len(folders(schema)) == 1
    listed = pieces.pieces(spark, "idx")
    text = plan(pieces.rows_in(spark, "idx", listed.where("piece = 3")))
    assert "dynamicpruning" in text and pieces.rows_in(spark, "idx", listed.where("piece = 3")).count() <= 30
    # Of a pack that is mostly written anew, all cells are; what no list names is dropped.
    for i in range(3):
        rows[i * 150 : i * 150 + 150] = [(k, f"{t} new{i}", *r) for k, t, *r in rows[i * 150 : i * 150 + 150]]
        kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=30)
    state(spark, "idx")
    assert len(folders(schema)) <= 8 and spark.table("idx__rows").count() <= 600 * 4
    for r in kc.open_cells(spark, "idx").cells.groupBy(F.expr("cell div 64")).agg(F.count("*").alias("n"), F.max("pack_cells").alias("all")).collect():
        assert 2 * r.n >= r.all


def test_large_cells_have_folders_of_their_own(spark, schema, monkeypatch):
    monkeypatch.setattr(kc, "PACK_ROWS", 30)
    kc.sync_cells(products(spark, catalogue(300)), "idx", embedder, cell_rows=30)
    kc.sync_cells(products(spark, catalogue(310, 300)), "idx", embedder, cell_rows=30)
    rows, cells = state(spark, "idx")
    assert len(rows) == 10 and all(c % 64 == 0 for c in cells)


def test_a_table_with_a_folder_for_each_cell_stays_so(spark, schema, monkeypatch):
    inner = pieces.add_rows
    with monkeypatch.context() as m:
        m.setattr(pieces, "add_rows", lambda df, name, path=None, packed=False: inner(df, name, path))
        m.setattr(kc, "PACK_ROWS", 30 * 64)
        kc.sync_cells(products(spark, catalogue(100)), "idx", embedder, cell_rows=30)
    assert not pieces.is_packed(spark, "idx")
    rows = catalogue(120, 20)
    kc.sync_cells(products(spark, rows), "idx", embedder, cell_rows=30)
    assert {r[KEY] for r in state(spark, "idx")[0]} == {r[0] for r in rows}
    frame = ix.embedded(products(spark, rows), embedder)
    asked = query_table(spark, np.ones((1, 16)))
    assert triples(kc.search_cells(kc.open_cells(spark, "idx"), asked, 5)) == triples(best_matches(frame, asked, 5))


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """An index that has been synced from other rows, and the same as one frame."""
    with schema_in(spark, tmp_path_factory.mktemp("kept")):
        kc.sync_cells(products(spark, catalogue(250)), "idx", embedder, attributes=["age", "play type", "size"], cell_rows=25)
        rows = catalogue(400, 50)
        kc.sync_cells(products(spark, rows), "idx", embedder, attributes=["age", "play type", "size"], cell_rows=25)
        frame = ix.embedded(products(spark, rows), embedder).join(products(spark, rows), KEY)
        yield kc.open_cells(spark, "idx"), frame


@pytest.mark.parametrize("k", [1, 60])
def test_search_equals_the_whole_search(spark, kept, k):
    cells, frame = kept
    vectors = [r.embedding for r in frame.orderBy(KEY).limit(40).collect()] + [[0.0] * 16, [1.0] * 16, [-1.0] * 16]
    queries = query_table(spark, vectors + vectors[:20])
    assert triples(kc.search_cells(cells, queries, k)) == triples(best_matches(frame, queries, k))


@pytest.mark.parametrize(
    "having", [{"age": ["kids"]}, {"age": [None]}, {"play type": ["b, c"], "size": [1, 2]}, {"age": ["nobody"]}, {"size": []}]
)
def test_search_with_values(spark, kept, having):
    cells, frame = kept
    queries = query_table(spark, [r.embedding for r in frame.limit(10).collect()])
    test = F.lit(True)
    for name, values in having.items():
        test = test & kc._one_of(name, values)
    assert triples(kc.search_cells(cells, queries, 4, having=having)) == triples(best_matches(frame.where(test), queries, 4))
    with pytest.raises(ValueError, match="does not keep"):
        kc.search_cells(cells, queries, having={"colour": ["red"]})


def test_cells_without_a_value_are_not_read(spark, schema):
    rows = [(f"p{i}", f"w{i % 10} w{i % 10} w{i % 10} z{i}", f"v{i % 10}") for i in range(300)]
    kc.sync_cells(products(spark, rows), "idx", embedder, attributes=["age"], cell_rows=30)
    cells = kc.open_cells(spark, "idx")
    some = cells.cells.where(kc._may_hold("age", ["v3"])).count()
    assert 0 < some < cells.cells.count() / 2
    assert cells.cells.where(kc._may_hold("age", ["none"])).count() == 0
    asked = query_table(spark, [[1.0] * 16])
    sums = [spark.sparkContext.accumulator(0) for _ in range(2)]
    all_ = kc.search_cells(cells, asked, 3, counter=sums[0]).collect()
    few = kc.search_cells(cells, asked, 3, having={"age": ["v3"]}, counter=sums[1]).collect()
    assert len(all_) == len(few) == 3 and sums[1].value <= 30 and sums[1].value < sums[0].value


# Many queries over a corpus without a layout.


def clustered(spark, n, dim=8, groups=15, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    vectors = np.float32(middles[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, dim)))
    return middles, vectors


def frame_of(spark, vectors):
    rows = [(str(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{KEY} string, embedding array<float>").repartition(5)


@pytest.mark.parametrize("k", [1, 4, 300])
def test_many_queries(spark, monkeypatch, k):
    middles, vectors = clustered(spark, 900)
    vectors[:300] = vectors[0]
    vectors[899] = 0
    asked = np.vstack([vectors[295:420], vectors[295:330], np.zeros((2, 8)), -vectors[:3]])
    monkeypatch.setattr(pruned, "QUERIES", 20)
    got = pruned.best_matches_of_many(frame_of(spark, vectors), query_table(spark, asked), k, cell_rows=40)
    assert triples(got) == triples(best_matches(frame_of(spark, vectors), query_table(spark, asked), k))


def test_small_blocks_of_cells(spark, monkeypatch):
    """Pivots, groups and pairs in many blocks, as with very many cells."""
    _, vectors = clustered(spark, 300)
    monkeypatch.setattr(pruned, "ROWS", 3)
    monkeypatch.setattr(pruned, "SCORES", 5)
    got = pruned.best_matches_of_many(frame_of(spark, vectors), query_table(spark, vectors[:60]), 4, cell_rows=20)
    assert triples(got) == triples(best_matches(frame_of(spark, vectors), query_table(spark, vectors[:60]), 4))


def test_pairs_that_cannot_matter_are_not_scored(spark):
    middles, vectors = clustered(spark, 2000)
    asked = np.vstack([middles[i % 15] + 0.05 * np.random.default_rng(i).normal(size=8) for i in range(200)])
    scores = spark.sparkContext.accumulator(0)
    got = pruned.best_matches_of_many(
        frame_of(spark, vectors), query_table(spark, asked), 3, cell_rows=50, counter=scores
    )
    assert triples(got) == triples(best_matches(frame_of(spark, vectors), query_table(spark, asked), 3))
    assert scores.value < 2000 * 200 / 5


def test_equal_queries_are_asked_once(spark):
    _, vectors = clustered(spark, 200)
    scores = spark.sparkContext.accumulator(0)
    asked = query_table(spark, [vectors[i % 2] for i in range(500)])
    got = pruned.best_matches_of_many(frame_of(spark, vectors), asked, 2, cell_rows=1000, counter=scores)
    assert got.count() == 1000 and scores.value <= 2 * 200


def test_bad_and_empty_input(spark):
    _, vectors = clustered(spark, 30)
    frame = frame_of(spark, vectors)
    none = query_table(spark, [])
    assert pruned.best_matches_of_many(frame, none, 2).count() == 0
    assert pruned.best_matches_of_many(frame.limit(0), query_table(spark, vectors[:2]), 2).count() == 0
    twice = query_table(spark, vectors[:2]).union(query_table(spark, vectors[2:4]))
    with pytest.raises(Exception, match="distinct"):
        pruned.best_matches_of_many(frame, twice, 2).collect()
    odd = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), (None, [1.0, 0.0]), ("d", [None, 1.0]), ("e", [-1.0, 0.0])],
        f"{KEY} string, embedding array<float>",
    )
    rows = pruned.best_matches_of_many(odd, query_table(spark, [[2.0, 0.0]]), 9, cell_rows=2).orderBy("rank").collect()
    assert [(r[2], r.score) for r in rows] == [("a", 1.0), ("b", 0.0), ("d", 0.0), ("e", -1.0)]


def test_cells_are_there_once_however_many_partitions(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "id int, v array<double>")
    cells = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "cell int, pivot array<double>")
    near = pruned.nearest_cells(rows, cells)
    assert "Generate" not in plan(near)
    assert {r.id: r.cell for r in near.collect()} == {i: int(i == 0) for i in range(50)}


def test_queries_are_sent_once_for_a_lot_of_cells(spark, monkeypatch):
    sent = spark.sparkContext.accumulator(0)
    inner = pruned._met_scores

    def counted(*how):
        run = inner(*how)

        def each(batches):
            for batch in batches:
                for asked in batch["asked"]:
                    sent.add(sum(len(q) for q in asked.values.field("queries")))
                yield from run([batch])

        return each

    vectors = np.random.default_rng(5).normal(size=(400, 8))
    vectors[:150] = vectors[0]
    got = best_matches(frame_of(spark, vectors), query_table(spark, vectors), 3)
    monkeypatch.setattr(pruned, "_met_scores", counted)
    monkeypatch.setattr(pruned, "QUERIES", 10)
    monkeypatch.setattr(pruned, "BUNDLE", 30)
    monkeypatch.setattr(pruned, "ROWS", 64)
    for lot in (150, 10_000):
        monkeypatch.setattr(pruned, "LOT", lot)
        sent.value = 0
        many = pruned.best_matches_of_many(frame_of(spark, vectors), query_table(spark, vectors), 3, cell_rows=5)
        assert triples(many) == triples(got)
        # 251 different queries and some 20 blocks of rows, in two passes; pairs of groups and cells would send 80 times as many.
        assert sent.value < 251 * 25 * 2
