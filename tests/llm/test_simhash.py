import random
import re

import numpy as np
import pytest
import xxhash
from inputs import FOLDER, ODD, docs

from shelfmark.llm import simhash
from shelfmark.llm.components import components
from shelfmark.llm.queries import QUERIES


def brute_print(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=4):
    """print -> smallest print that can be reached."""
    left, root = set(prints), {}
    for p in sorted(prints):
        if p in left:
            reached, wave = {p}, [p]
            left.discard(p)
            while wave:
                x = wave.pop()
                near = [y for y in left if (x ^ y).bit_count() <= bits]
                left.difference_update(near)
                wave += near
                reached.update(near)
            root |= dict.fromkeys(reached, p)
    return root


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = brute_groups({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted((str(i), f"{p:016x}", str(least.get(root[p]))) for i, p in prints)


def got(frame):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in frame.collect())


def test_odd_documents(spark):
    assert got(simhash.near_duplicates(docs(spark, ODD))) == brute(ODD)
    kept = simhash.without_near_duplicates(docs(spark, ODD))
    assert kept.columns == docs(spark, ODD).columns
    smallest = {c for _, _, c in brute(ODD)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(smallest)


def test_nothing(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.without_near_duplicates(docs(spark, [])).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got(QUERIES["op10_simhash"](spark, FOLDER)) == brute(rows)


@pytest.mark.parametrize("limit", [3, 40, 20_000])
@pytest.mark.parametrize("bits", [0, 4, 6])
def test_groups_with_long_lists(spark, limit, bits):
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(4)] + [0]
    prints = set(seeds)
    for _ in range(220):
        p = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 7)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    rows = simhash.fingerprint_groups(frame, bits, limit).collect()
    whole = {r.fp & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in rows}
    wanted = brute_groups(prints, bits)
    groups = lambda root: {frozenset(q for q in prints if root.get(q, q) == r) for r in {root.get(p, p) for p in prints}}
    assert groups(whole) == groups(wanted)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.root for r in rows} == {x: find(x) for x in linked} and len(rows) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
