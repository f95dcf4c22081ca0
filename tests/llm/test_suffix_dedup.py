import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import FOLDER, ODD, docs

import corpus_pipeline
from shelfmark.llm import suffix_dedup
from shelfmark.llm.queries import QUERIES


def brute(texts, length=400):
    """n_bytes, n_removed, n_spans and kept bytes of every text."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        flags = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.r_[False, flags].astype(int)) == 1).sum())
        out.append((len(b), int(flags.sum()), spans, bytes(x for x, f in zip(b, flags) if not f)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x & 1 for x in b)), max_size=8), st.sampled_from([(4, 2), (8, 4), (6, 2)]),
       st.sampled_from([9, 10_000]), st.data())
def test_merged_transforms(segments, sizes, shard, data):
    length, symbol = sizes
    weights = [data.draw(st.integers(1, 2)) for _ in segments]
    if not segments:
        return
    counts = Counter()
    for s, w in zip(segments, weights):
        for i in range(len(s) - length + 1):
            counts[s[i : i + length]] += w
    found = suffix_dedup.repeated_windows(segments, weights, length, symbol, shard)
    for s, f in zip(segments, found):
        assert f.tolist() == [counts[s[i : i + length]] > 1 for i in range(max(0, len(s) - length + 1))]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300).map(lambda b: bytes(x & 3 for x in b)))
def test_equal_windows_have_equal_anchors(text):
    anchors, first, beyond, place = suffix_dedup.segments_of(text, 20, 4)
    assert [i for a, b in zip(first, beyond) for i in range(a, b)] == list(range(max(0, len(text) - 19)))
    seen = {}
    for h, a, b, p in zip(anchors, first, beyond, place):
        for i in range(a, b):
            assert i <= p <= i + 16 and seen.setdefault(text[i : i + 20], (h, p - i)) == (h, p - i)


def rows(frame):
    return sorted((str(r.row.doc_id), *list(r.cut)[:3], bytes(r.cut.kept)) for r in frame.collect())


@pytest.mark.parametrize("limit", [2, 2000])
def test_passages(spark, limit):
    rng = random.Random(3)
    letters = "abcdefgh é"
    passage = "".join(rng.choice(letters) for _ in range(90))
    hot = "".join(rng.choice(letters) for _ in range(45))
    data = []
    for i in range(60):
        own = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        text = own[:50] + (passage[rng.randint(0, 20) : rng.randint(60, 90)] if i % 3 == 0 else "") + (hot if i % 2 else "") + own[50:]
        data.append((i, text))
    data += [(100, "ab" * 100), (101, data[0][1]), (102, data[0][1]), (103, passage), (103, passage), *ODD]
    got = rows(suffix_dedup.with_repeats_removed(
        docs(spark, data), length=40, gram=8, symbol=8, block=2000, shard=500, group_limit=limit
    ))
    wanted = brute([t for _, t in data], 40)
    assert got == sorted((str(i), *w) for (i, _), w in zip(data, wanted))
    assert sum(w[1] for w in wanted) > 0


def test_nothing(spark):
    assert suffix_dedup.with_repeats_removed(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.with_repeats_removed(docs(spark, []), length=401)


def test_query(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    wanted = sorted((i, *w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(data, brute([t for _, t in data])))
    assert sorted(tuple(r) for r in QUERIES["op5_suffix_dedup"](spark, FOLDER).collect()) == wanted


def test_stage_keeps_whole_characters(spark):
    shared = "é" * 300
    data = [(1, "xé" + shared), (2, "é" + shared + "ü end"), (3, None), (4, "short"), (5, "")]
    frame = docs(spark, data)
    out = corpus_pipeline.without_repeats(spark, frame, FOLDER)
    assert out.columns == frame.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[3] == (None, None) and got[4] == ("short", 5) and got[5] == ("", 0)
    assert got[1] == ("x", 1) and got[2] == (" end", 4)


def test_shard_order_sorts_by_symbols():
    rng = np.random.default_rng(4)
    text = np.r_[rng.integers(97, 99, 300), np.tile(rng.integers(97, 99, 20), 20), np.zeros(4, int)].astype(np.uint8)
    n = 700
    ranks = suffix_dedup.symbol_ranks(text, 4)[: n + 1]
    left = n - np.arange(n + 1)
    body = text.tobytes()
    wanted = sorted(range(n + 1), key=lambda p: ([body[q : q + 4] for q in range(p, n - 3, 4)], p))
    assert suffix_dedup.shard_order(ranks, left, 4).tolist() == wanted


def test_merge_needs_the_order(monkeypatch):
    """The step to the left is read off the transform, so suffixes in another order give other windows."""
    rng = np.random.default_rng(5)
    base = rng.integers(97, 101, 60).astype(np.uint8).tobytes()
    segments = [base, base[5:50], base[:30] + b"x" + base[31:], rng.integers(97, 101, 60).astype(np.uint8).tobytes()]
    right = suffix_dedup.repeated_windows(segments, [1] * 4, 16, 4, 64)
    every = [s[i : i + 16] for s in segments for i in range(len(s) - 15)]
    assert [r.tolist() for r in right] == [
        [every.count(s[i : i + 16]) > 1 for i in range(len(s) - 15)] for s in segments
    ]
    monkeypatch.setattr(suffix_dedup, "shard_order", lambda ranks, left, symbol: np.arange(len(left)))
    wrong = suffix_dedup.repeated_windows(segments, [1] * 4, 16, 4, 64)
    assert [r.tolist() for r in wrong] != [r.tolist() for r in right]
