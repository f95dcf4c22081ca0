import hashlib

import pytest
from inputs import docs, sentence

from shelfmark.llm import decontaminate
from shelfmark.llm.queries import QUERIES

ITEMS = [(None, sentence(1)), (None, sentence(2)), (4, sentence(3)), (None, None)]
ROWS = [(1, "a " + sentence(1) + " b"), (2, sentence(3) + " " + sentence(2)), (3, sentence(3)), (4, "clean")]
SHAPE = "item_id int, text string"


@pytest.mark.parametrize("words_per_pass", [1_000_000, 5])
def test_are_searched_for(spark, words_per_pass):
    found = decontaminate.find_contamination(docs(spark, ROWS), spark.createDataFrame(ITEMS, SHAPE), words_per_pass=words_per_pass)
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.unnamed) for r in found.collect())
    assert got == [(1, 14, 12, [], True), (2, 24, 24, ["4"], True), (3, 12, 12, ["4"], False), (4, 1, 0, [], False)]
    clean = decontaminate.without_contaminated(
        docs(spark, ROWS), spark.createDataFrame(ITEMS, SHAPE), words_per_pass=words_per_pass
    )
    assert [r.doc_id for r in clean.collect()] == [4]


def test_count_as_in_the_sql(spark, tmp_path):
    docs(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, SHAPE).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in QUERIES["op9_wu_manber"](spark, str(tmp_path)).collect())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == [(1, 12, 1, sha(b"")), (2, 24, 2, sha(b"4")), (3, 12, 1, sha(b"4")), (4, 0, 0, sha(b""))]
