import math

import numpy as np
import pytest
from inputs import FOLDER

from shelfmark.llm import whitening
from shelfmark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n long, x string, component int, `a.b` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA)


def exact(matrix):
    """Distinct whole vectors, eigenvalues and eigenvectors of their covariance."""
    x = np.floor(256 * np.asarray(matrix, np.float64)) + 0
    once = np.unique(x, axis=0)
    centred = once - once.mean(axis=0)
    values, components = np.linalg.eigh(centred.T @ centred / len(once))
    return x, once, values[::-1], components[:, ::-1]


def same(model, matrix, k=4):
    _, once, values, components = exact(matrix)
    assert model.n == len(once) and model.sums == [int(s) for s in once.sum(axis=0)]
    assert np.allclose(model.values, values[:k], rtol=1e-12)
    assert abs(model.trace - values.sum()) < 1e-9 * max(1, values.sum()) and model.error < 1e-9
    return components[:, :k]


def compare(rows, ids, matrix):
    x, once, values, components = exact(matrix)
    n, sums = len(once), [int(s) for s in once.sum(axis=0)]
    want = (x - once.mean(axis=0)) @ components[:, :4] / np.sqrt(values[:4])
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == 4 * len(ids)
    for k in range(4):
        column = np.array([got[i, k + 1].whitened for i in ids])
        sign = np.sign((column * want[:, k]).sum())
        assert np.allclose(sign * column, want[:, k], atol=1e-8)
    for i, row in zip(ids, x):
        r = got[i, 1]
        assert r.n == n and r.deviation == sum((n * int(c) - s) ** 2 for c, s in zip(row, sums))
        assert math.isclose(got[i, 2].explained, values[1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error <= 1e-6


def test_rows_that_take_no_part(spark):
    random = np.random.default_rng(5)
    good = (random.standard_normal((60, 6)) * [5, 3, 2, 1, 1, 1]).astype(np.float32).tolist()
    bad = [
        (900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [math.nan] * 6), (903, [math.inf] + [0.0] * 5),
        (904, [-math.inf] + [0.0] * 5), (905, []), (906, [1.0] * 7),
    ]
    rows = [*enumerate(good), (100, good[0]), (101, good[0]), (102, [0.0] * 6), (103, [-0.0] * 6), *bad]
    frame = vectors(spark, rows)
    model = whitening.fit(frame)
    kept = [(i, v) for i, v in rows if i < 900]
    same(model, [v for _, v in kept])
    compare(whitening.whiten(frame, model).collect(), [i for i, _ in kept], [v for _, v in kept])


def test_equal_eigenvalues(spark):
    """One start meets one direction of equal values only: the others come from fresh ones."""
    axes = np.concatenate([np.eye(7) * 3, -np.eye(7) * 3, np.eye(7)[:1] * 5, -np.eye(7)[:1] * 5])
    model = whitening.fit(vectors(spark, list(enumerate(axes.tolist()))))
    same(model, axes)
    spread = np.concatenate([axes * s for s in (1, 2, 3)])
    same(whitening.fit(vectors(spark, list(enumerate(spread.tolist()))), 6), spread, 6)


@pytest.mark.parametrize("rank", [1, 2, 3])
def test_low_rank(spark, rank):
    random = np.random.default_rng(rank)
    rows = random.integers(-5, 5, (40, rank)) @ random.integers(-3, 4, (rank, 9))
    model = whitening.fit(vectors(spark, [(i, [float(x) for x in r]) for i, r in enumerate(rows)]))
    assert len(model.values) == np.linalg.matrix_rank(rows - rows.mean(axis=0)) and model.error < 1e-9
    assert np.allclose(model.values, exact(rows)[2][: len(model.values)])


def test_nothing_to_fit(spark):
    empty = vectors(spark, [])
    assert whitening.fit(empty) is None and whitening.whiten(empty, None).count() == 0
    alike = vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    model = whitening.fit(alike)
    assert model.n == 1 and len(model.values) == 0 and whitening.whiten(alike, model).count() == 0
    two = vectors(spark, [(1, [1.0, 2.0]), (2, [1.5, 2.0]), (None, [1.5, 2.0])])
    assert [(r.vec_id, r.component, r.n) for r in whitening.whiten(two, whitening.fit(two)).orderBy("vec_id").collect()] == [
        (None, 1, 2), (1, 1, 2), (2, 1, 2)
    ]


def test_very_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0]), (4, [1e9, 2.0])]
    frame = vectors(spark, rows)
    model = whitening.fit(frame)
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame, model).collect()}
    limit = 1 << 50
    x = {1: (limit, 0), 2: (-limit, 256), 3: (0, 512), 4: (256 * 10**9, 512)}
    sums = [sum(c) for c in zip(*x.values())]
    for i, row in x.items():
        wanted = sum((4 * c - s) ** 2 for c, s in zip(row, sums))
        assert got[i] == (wanted if wanted < 1 << 63 else None)
    assert model.sums == sums


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    compare(QUERIES["op12_whitening"](spark, FOLDER).collect(), [r.vec_id for r in table], [r.embedding for r in table])
