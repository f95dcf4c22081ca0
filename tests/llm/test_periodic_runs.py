import hashlib
import re
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import FOLDER, ODD, docs

from shelfmark.llm import periodic_runs as pr
from shelfmark.llm.queries import QUERIES


def brute(w, copies=4, least=6):
    """Every lag and every stretch that agrees with itself, primitive ones only."""
    out = []
    for q in range(1, len(w) // copies + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if j > i and len(s) >= max(least, copies * q):
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, len(s), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_rewrite(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


PIECES = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 9)), max_size=8)


@settings(max_examples=400, deadline=None)
@given(PIECES, st.sampled_from([3, 4, 5, 9]), st.sampled_from([1, 6, 11]))
def test_against_brute_force(pieces, copies, least):
    words = [c.encode() for body, times in pieces for c in body * times]
    assert pr.runs_of(words, copies, least) == brute(words, copies, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=80))
def test_segments_are_stable_and_hold_all(ids):
    found = pr.surviving(pr.np.array(ids, pr.np.int64))
    for a, b in found:
        assert b - a >= 6 and all(ids[a:b].count(x) >= 4 for x in ids[a:b])
    inside = {i for a, b in found for i in range(a, b)}
    for a in range(len(ids)):
        for b in range(a + 6, len(ids) + 1):
            if all(ids[a:b].count(x) >= 4 for x in ids[a:b]):
                assert set(range(a, b)) <= inside


def test_long_runs():
    assert pr.runs_of([b"w"] * 30_000) == [(0, 30_000, 1)]
    period = [b"%d" % (i * i % 977) for i in range(1500)]
    smallest = min(q for q in range(1, 1501) if (period * 2)[q : q + 1500] == period)
    assert pr.runs_of([b"x"] + period * 5 + [b"y"]) == brute([b"x"] + period * 5 + [b"y"])
    assert (1, 7500, smallest) in pr.runs_of([b"x"] + period * 5 + [b"y"])


def expected(doc_id, text, rewrite=lambda _, w: w):
    words = rewrite(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words) if len(words) < 5000 else [(0, len(words), 1)]
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return words, runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_odd_documents(spark):
    odd = [*ODD, (11, "a b " * 9 + "\x1c c"), (12, " x  " * 7)]
    rows = pr.find_runs(docs(spark, odd)).collect()
    got = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows if r.doc_id is not None)
    want = [(i, *expected(i, t)) for i, t in odd if i is not None]
    assert got == sorted((i, len(w), runs, left) for i, w, runs, left in want)
    assert sorted(r.n_words for r in rows if r.doc_id is None) == [0, 12]
    assert pr.find_runs(docs(spark, [])).count() == 0


def test_strongest(spark):
    rows = [([(0, 8, 2), (5, 13, 3), (9, 26, 6), (20, 9, 2)],), ([(0, 8, 2), (1, 12, 3), (1, 4, 1)],), ([],), (None,)]
    frame = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    got = [r[0] and tuple(r[0]) for r in frame.select(pr.strongest(pr.F.col("runs"))).collect()]
    assert got == [(20, 9, 2), (0, 8, 2), None, None]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        _, runs, left = expected(r.doc_id, texts[r.doc_id], brute_rewrite)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in rows) > 10
