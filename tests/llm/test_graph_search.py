import numpy as np
import pytest
from inputs import FOLDER

from shelfmark.llm import graph_search
from shelfmark.llm.queries import QUERIES


def brute(rows, queries, k):
    """query -> [(vec_id, score)] over all usable rows."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for q, v in good:
        if q in queries:
            near = [(-float(np.dot(np.array(v), np.array(w))), i) for i, w in good if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, wanted):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in wanted.items())
    return hit / sum(map(len, wanted.values()))


def test_query_recall(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = found(QUERIES["op7_graph_search"](spark, folder))
    x = {i: np.array(v, float) for i, v in rows}
    every = np.array([x[i] for i, _ in rows])
    ids = np.array([i for i, _ in rows])
    wanted = {}
    for q in x:
        if q % 20 == 0:
            s = every @ x[q]
            s[ids == q] = -np.inf
            wanted[q] = [(int(ids[i]), s[i]) for i in np.lexsort((ids, -s))[:20]]
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.9
    for q, near in got.items():
        assert len(near) == 20 and near == sorted(near, key=lambda n: (-n[1], n[0]))
        assert all(abs(x[q] @ x[i] - s) < 1e-12 for i, s in near)


@pytest.mark.parametrize("shard_rows", [7, 100])
def test_odd_vectors(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]  # one vector, many ids
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0.0, 0.0, 1.0]),
             (205, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (206, [1.0, 2.0]), (3, rows[3][1]), (220, [5.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1.0, 1) for i, v in rows], "vec_id long, embedding array<float>, score double, shard int")
    index = graph_search.build_index(frame, k=5, shard_rows=shard_rows)
    got = found(graph_search.search_index(index, frame.where("vec_id % 20 = 0"), k=5, block=2))
    wanted = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 5)
    assert set(got) == set(wanted)
    assert recall(got, wanted) >= 0.98
    assert [i for i, _ in got[120]] == [i for i, _ in wanted[120]] and got[220] == [(206, 5.0)]


UNIT = np.random.default_rng(5).normal(size=(2400, 32))
UNIT /= np.linalg.norm(UNIT, axis=1)[:, None]
STRETCH = np.random.default_rng(6).normal(size=(2400, 1))
CLUSTERS = UNIT[np.arange(2400) % 30] + UNIT[::-1] * 0.05
SHAPES = {
    "unit": UNIT, "gaussian": UNIT * (1 + 0.1 * STRETCH), "spread 0.3": UNIT * np.exp(0.3 * STRETCH),
    "spread 1.0": UNIT * np.exp(STRETCH), "spread 1.5": UNIT * np.exp(1.5 * STRETCH), "clusters": CLUSTERS,
    "stretched clusters": CLUSTERS * np.exp(STRETCH), "off centre": UNIT + 0.4, "huge": UNIT * 1e100,
}


def _as_bands(x):
    out = []
    for band in graph_search.bands(x):
        exact = x[band]
        points = graph_search.augmented(exact / np.abs(exact).max()).astype(np.float32)
        out.append(([[int(i)] for i in band], exact, points, *graph_search.build_graph(points)))
    return out


def _searched(x, every, k=20, beam=graph_search.SEARCH_BEAM):
    """Recall, and the least number of neighbours that a query got."""
    queries = [(i, x[i].tolist()) for i in range(0, len(x), every)]
    out = ([], [], [])
    graph_search._nearest(queries, _as_bands(x), k, beam, out)
    got = {q: [] for q, _ in queries}
    for q, m in zip(out[0], out[1]):
        got[q].append((m, 0.0))
    wanted = {}
    for q in got:
        s = x @ x[q]
        s[q] = -np.inf
        wanted[q] = [(int(i), s[i]) for i in np.argsort(-s, kind="stable")[: min(k, len(x) - 1)]]
    return recall(got, wanted), min(map(len, got.values()))


@pytest.mark.parametrize("shape", SHAPES)
def test_recall_of_any_lengths(shape):
    hit, least = _searched(SHAPES[shape], 24)
    assert hit >= 0.95 and least == 20


def test_small_tables_are_found_whole():
    rng = np.random.default_rng(7)
    for n in [2, 3, 5, 10, 20, 21, 22, 30, 60, 100, 128, 129, 200] * 4:
        x = rng.normal(size=(n, int(rng.integers(1, 9)))) * 0.01 + np.where(np.arange(n) % 2, 5, -5)[:, None]
        hit, least = _searched(x, 1)
        assert least == min(20, n - 1) and (hit == 1 or n > graph_search.SEARCH_BEAM and hit > 0.9), n


def test_every_point_is_reached():
    edges = np.array([[1], [0], [3], [2], [-1], [4]], np.int32)
    assert graph_search.with_unreached(edges, np.array([0])).tolist() == [0, 2, 4, 5]


def test_bands():
    x = np.array([[1.0], [8], [7.9], [2], [1.95], [0.5]])
    assert [b.tolist() for b in graph_search.bands(x, 1.1, 1)] == [[1, 2], [3, 4], [0], [5]]
    assert [b.tolist() for b in graph_search.bands(x, 1.1, 4)] == [[1, 2, 3, 4], [0, 5]]


def test_lengths_through_spark(spark):
    x = SHAPES["spread 1.0"]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = graph_search.build_index(frame, shard_rows=800)
    got = found(graph_search.search_index(index, frame.where("vec_id % 20 = 0"), block=32))
    wanted = {}
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        wanted[q] = [(int(i), s[i]) for i in np.argsort(-s, kind="stable")[:20]]
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.95
    assert all(len(near) == 20 for near in got.values())


def test_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert graph_search.search_index(graph_search.build_index(none), some).count() == 0
    assert graph_search.search_index(graph_search.build_index(some), none).count() == 0
    assert graph_search.search_index(graph_search.build_index(some), some).count() == 0


def test_pruning_keeps_diverse_edges():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 1], [5, 5]], np.float32)
    kept = graph_search.pruned(points, np.array([0]), np.array([[1, 2, 3, 4, 0, -1]]), 3, 1.0)
    assert kept.tolist() == [[1, 3, -1]]
