import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import FOLDER, ODD, docs, sentence

from shelfmark.llm import decontaminate
from shelfmark.llm.queries import QUERIES


def plain_words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        w = plain_words(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i : i + window]
            for j in range(len(words) - len(part) + 1):
                if words[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


TEXT = st.lists(st.sampled_from(["a", "b", "A", "c.", "é", "1"]), max_size=25).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(TEXT, max_size=4), st.integers(1, 6))
def test_search_against_brute_force(text, items, window):
    rows = list(enumerate(items))
    found, of = decontaminate._search(rows, window)
    words, hit, seen = decontaminate.words_of(text.encode()), set(), set()
    for machine in found:
        machine = decontaminate.Machine(*machine)
        for start, w in decontaminate.occurrences(words, machine):
            hit.update(range(start, start + machine.length))
            seen.update(of[w])
    assert (len(words), len(hit), sorted(seen)) == brute(text, rows, window)


@pytest.mark.parametrize("words_per_pass", [1_000_000, 5])
def test_odd_inputs(spark, words_per_pass):
    items = [(1, sentence(1)), (2, "one"), (3, None), (4, ""), (5, "ünïcode École"), (2, "one"), (None, "x"), (7, sentence(3, 40))]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate.find_contamination(docs(spark, ODD), benchmark, words_per_pass=words_per_pass).collect()
    usable = [i for i in items if i[0] is not None]
    wanted = sorted((str(i), *brute(t, usable)) for i, t in ODD)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == wanted
    assert all(r.n_hit == sum(x.b - x.a for x in r.runs) for r in got)
    clean = decontaminate.without_contaminated(docs(spark, ODD), benchmark, words_per_pass=words_per_pass)
    assert clean.columns == docs(spark, ODD).columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(w[0] for w in wanted if not w[2])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.find_contamination(docs(spark, []), none).count() == 0
    rows = decontaminate.find_contamination(docs(spark, ODD), none).collect()
    assert len(rows) == len(ODD) and not any(r.n_hit for r in rows)
    assert decontaminate.without_contaminated(docs(spark, ODD), none).count() == len(ODD)


def test_query(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op9_wu_manber"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, hit, found = brute(texts[r.doc_id], items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)
