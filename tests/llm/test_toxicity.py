import numpy as np
import zlib
from inputs import FOLDER, ODD, docs, sentence

from shelfmark.llm import toxicity
from shelfmark.llm.queries import QUERIES


def test_features_are_the_set_of_ngrams():
    def plain(text):
        grams = set()
        for w in text.split():
            marked = f"^{w}$"
            for n in toxicity.ORDERS:
                grams |= {marked[i : i + n] for i in range(max(1, len(marked) - n + 1))}
        return sorted({zlib.crc32(g.encode()) % 1000 for g in grams})

    f = toxicity.Features(1000)
    assert f.of("Été a BAD, bad!".encode()).tolist() == plain("été a bad bad")
    assert f.of(None).tolist() == f.of(b"").tolist() == f.of(b" ,. ").tolist() == []


def test_ratios():
    offsets, indices = np.array([0, 2, 3]), np.array([0, 1, 1])
    got = toxicity.log_count_ratios(offsets, indices, np.array([True, False]), 3)
    p, q = np.array([2, 2, 1]) / 5, np.array([1, 2, 1]) / 4
    assert np.allclose(got, np.log(p / q))


def test_fit_finds_the_least_loss():
    rng = np.random.default_rng(0)
    x = rng.random((60, 12)) < 0.4
    toxic = x[:, 0] | (rng.random(60) < 0.1)
    offsets, indices = np.r_[0, np.cumsum(x.sum(1))], np.nonzero(x)[1]
    ratios = toxicity.log_count_ratios(offsets, indices, toxic, 12)
    model = toxicity.fit_logistic(offsets, indices, toxic, ratios, rounds=300)
    values = x * ratios
    point = np.r_[np.where(ratios == 0, 0, model.weights / np.where(ratios == 0, 1, ratios)), model.bias]

    def slope(p):
        margin = values @ p[:-1] + p[-1]
        error = 1 / (1 + np.exp(-margin)) - toxic
        return np.r_[values.T @ error + toxicity.PENALTY * p[:-1], error.sum()]

    assert np.abs(slope(point)).max() < 0.05


def labelled(spark, n=120):
    rows = [(i, sentence(i, 30) + (" you moronic idiot" if i % 4 == 0 else "")) for i in range(n)]
    labels = [(i, 1 if i % 4 == 0 else 0, None) for i in range(n)]
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_odd_documents(spark):
    rows, labels = labelled(spark)
    more = spark.createDataFrame([(None, 1, None), (2, 1, None), (2, 0, None), (7, None, None), (999, 1, 1), (1, 0, None), (1, 0, None)], labels.schema)
    frame = docs(spark, [*rows, *ODD, (500, "what an idiot")])
    model = toxicity.fit(frame, labels.union(more))
    score = toxicity.toxicity(frame, "text", model)
    got = {r.doc_id: r.p for r in frame.select("doc_id", score.alias("p")).collect()}
    assert all(0 <= p <= 1 for p in got.values()) and got[500] > 0.7
    empty = [r.p for r in docs(spark, [(1, None), (2, ""), (3, " ")]).select(score.alias("p")).collect()]
    assert len(set(empty)) == 1 and empty[0] < 0.7


def test_one_kind_of_label_or_none(spark):
    rows, labels = labelled(spark, 20)
    frame = docs(spark, rows)
    for chosen, share in ((labels.where("toxic = 0"), 1 / 17), (labels.where("false"), 1 / 2)):
        score = toxicity.toxicity(frame, "text", toxicity.fit(frame, chosen))
        assert {round(r.p, 6) for r in frame.select(score.alias("p")).collect()} == {round(share, 6)}
    nothing = docs(spark, [])
    assert nothing.select(toxicity.toxicity(nothing, "text", toxicity.fit(nothing, labels)).alias("p")).count() == 0


def test_query_on_held_out_labels(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    rows = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, folder).collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    hits = {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    for label in spark.read.parquet(f"{folder}/labels.parquet").collect():
        r = rows[label.doc_id]
        assert r.held_out == (zlib.crc32(str(label.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7)
        if r.held_out:
            hits[label.toxic, r.predicted] += 1
    # 2636 texts to learn from, 305 of them toxic; with five times as many nearly all are caught.
    assert hits[1, 1] >= 0.6 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.01 * (hits[0, 0] + hits[0, 1])
    assert hits[0, 0] + hits[1, 1] >= 0.95 * sum(hits.values())
