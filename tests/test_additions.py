import random

import pytest
from conftest import plan

from shelfmark.operators import survivors as sv
from shelfmark.operators.catalogue import deduplicate
from shelfmark.plans import additions as plans
from shelfmark.plans.ingest import silver
from shelfmark.plans.regex_gold import coverage, regex_gold
from shelfmark.sources import pieces
from shelfmark.sources.tables import use_schema

SCHEMA = "k string, a string, b int"


@pytest.fixture
def shop(spark):
    before = spark.catalog.currentDatabase()
    use_schema(spark, f"shop_{random.randrange(10**12)}")
    yield spark
    spark.catalog.setCurrentDatabase(before)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "a", "b").collect()), key=repr)


def some_rows(rng, n):
    keys = [None, "", *(f"k{i}" for i in range(25)), *["hot"] * 15]
    return [(rng.choice(keys), rng.choice([None, "", "x", "y"]), rng.choice([None, 1, 2, 3])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_arrival_gives_the_full_run(shop, seed):
    rng = random.Random(seed)
    deliveries = [frame(shop, some_rows(rng, n)) for n in (40, 0, 60, 25)]
    deliveries.append(deliveries[2])  # one comes twice
    every = deliveries[0]
    for d in deliveries[1:]:
        every = every.unionByName(d)
    wanted = rows_of(deduplicate(every, "k"))
    for name in ("one", "two"):
        rng.shuffle(deliveries)
        for d in deliveries:
            sv.merge_additions(d, name, 8, "k")
        assert rows_of(shop.table(name)) == wanted


def numbers(spark, name):
    return {r.part: r.piece for r in pieces.pieces(spark, name).collect()}


def test_only_parts_with_a_new_survivor_are_written(shop):
    first = frame(shop, [(f"k{i}", "m", i) for i in range(100)])
    assert sv.merge_additions(first, "t", 16, "k", ["a", "b"]).count() == 100
    before = numbers(shop, "t")
    # Neither a row that loses nor the same rows again touch anything.
    assert sv.merge_additions(frame(shop, [("k1", "z", 1)]), "t", 16, "k", ["a", "b"]).count() == 0
    assert sv.merge_additions(first, "t", 16, "k", ["a", "b"]).count() == 0
    assert numbers(shop, "t") == before
    won = sv.merge_additions(frame(shop, [("k1", "a", 1), ("k2", "z", 1), (None, "x", 1)]), "t", 16, "k", ["a", "b"])
    assert {r.k for r in won.collect()} == {"k1", None}
    after = numbers(shop, "t")
    assert 1 <= sum(after[p] != before[p] for p in before) <= 2
    rows = {r.k: r.a for r in shop.table("t").collect()}
    assert len(rows) == 101 and rows["k1"] == "a" and rows["k2"] == "m" and rows[None] == "x"


def test_a_failed_merge_leaves_the_table(shop):
    sv.merge_additions(frame(shop, [("a", "x", 2), ("b", "x", 2)]), "t", 4, "k")
    before = rows_of(shop.table("t"))
    bad = frame(shop, [("a", "x", 1)]).selectExpr("k", "a", "raise_error('no') b").selectExpr("k", "a", "int(b) b")
    with pytest.raises(Exception, match="no"):
        sv.merge_additions(bad, "t", 4, "k")
    assert rows_of(shop.table("t")) == before
    with pytest.raises(ValueError):
        sv.merge_additions(frame(shop, []).drop("b"), "t", 4, "k")
    with pytest.raises(ValueError):
        sv.merge_additions(frame(shop, []), "t", 5, "k")


def test_rows_of_a_failed_change_do_not_count(shop):
    sv.merge_additions(frame(shop, [("a", "x", 2)]), "t", 4, "k")
    wrong = frame(shop, [("a", "wrong", 1)]).selectExpr("*", "99 AS piece")
    pieces.add_rows(wrong, "t")  # written, but its list was never published
    assert rows_of(shop.table("t")) == [("a", "x", 2)]
    sv.merge_additions(frame(shop, [("b", "y", 1)]), "t", 4, "k")
    assert rows_of(shop.table("t")) == [("a", "x", 2), ("b", "y", 1)]


def test_a_hot_key_sends_one_row_per_task(shop):
    hot = shop.range(3000).selectExpr("'hot' AS k", "string(id) AS a", "int(id) AS b")
    held = frame(shop, [("hot", "0", 0)])
    assert "WindowGroupLimit" in plan(sv.new_survivors(hot, held, "k", ["b"]))
    assert sv.new_survivors(hot, held, "k", ["b"]).count() == 0  # equal rows: the held one stays


RAW = (
    "headline_text string, product_name string, product_description string, category_name string, "
    "site_product_identifier string, availability_status string, line int"
)


def raw_rows(rng, start, n):
    words = ["xmas gift", "kids, space", "adults - building", "nothing", None]
    return [
        ("h", rng.choice(["n1", "n2"]), rng.choice(words), "c", rng.choice([None, *(str(i) for i in range(30))]),
         rng.choice(["E_AVAILABLE", "R_RETIRED", None]), start + i)
        for i in range(n)
    ]


def test_silver_gold_and_coverage_are_kept_up(shop):
    rng = random.Random(5)
    arrived = []
    for start in (200, 0, 100):  # earlier lines arrive later and win
        rows = raw_rows(rng, start, 60)
        arrived += rows
        plans.add_to_catalogue(shop.createDataFrame(rows, RAW), "survivors", 8, ["line"])
        plans.tag_additions(shop, "survivors", "gold")
        every = silver(shop.createDataFrame(arrived, RAW), ["line"])
        full = regex_gold(every)
        assert sorted(map(repr, plans.silver_of(shop, "survivors").collect())) == sorted(map(repr, every.collect()))
        assert sorted(map(repr, shop.table("gold").select(*full.columns).collect())) == sorted(map(repr, full.collect()))
        assert plans.kept_coverage(shop, "gold").collect() == coverage(full).collect()


def test_gold_follows_changed_parts_only(shop):
    rng = random.Random(6)
    plans.add_to_catalogue(shop.createDataFrame(raw_rows(rng, 100, 80), RAW), "survivors", 8, ["line"])
    assert plans.tag_additions(shop, "survivors", "gold").count() == 8
    assert plans.tag_additions(shop, "survivors", "gold").count() == 0
    one = ("h", "n", "xmas", "c", "7", "E_AVAILABLE", 1)
    plans.add_to_catalogue(shop.createDataFrame([one], RAW), "survivors", 8, ["line"])
    before = numbers(shop, "gold")
    renewed = {r.part for r in plans.tag_additions(shop, "survivors", "gold").collect()}
    after = numbers(shop, "gold")
    assert len(renewed) == 1 and {p for p in before if before[p] != after[p]} == renewed
    # The report reads the list of parts, no rows.
    files = plans.kept_coverage(shop, "gold").inputFiles()
    assert files and all("gold__pieces" in f for f in files)


def test_nothing_arrives(shop):
    none = shop.createDataFrame([], RAW)
    plans.add_to_catalogue(none, "survivors", 4)
    plans.tag_additions(shop, "survivors", "gold")
    assert shop.table("gold").count() == 0
    assert [(r.tagged, r.untagged) for r in plans.kept_coverage(shop, "gold").collect()] == [(0, 0)] * 7
    rows = shop.createDataFrame(raw_rows(random.Random(7), 0, 30), RAW)
    plans.add_to_catalogue(rows, "survivors", 4)
    plans.tag_additions(shop, "survivors", "gold")
    assert shop.table("gold").count() == silver(rows.drop("line")).count()
