import pytest
from inputs import ODD, docs, sentence
from test_lm_scoring import brute

from shelfmark.llm import lm_scoring


def scored(frame):
    return sorted(((repr(r.doc_id), r.n_words, r.target_loss, r.background_loss) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 500}])
def test_words_beyond_the_most_frequent(spark, how):
    # 2,100 words come before these by frequency; the texts 90 and 91 have none of them.
    common = [(i, " ".join(f"c{j}" for j in range(2100))) for i in range(20, 22)]
    rare = [(90, "alpha beta gamma delta"), (91, "rho sigma tau phi"), (92, "alpha beta gamma"), (93, "delta")]
    rows = [*ODD, *common, *rare, *((200 + i, sentence(i, 30)) for i in range(60))]
    target = spark.createDataFrame([(92,), (6,), (None,), (999,)], "doc_id long")
    got = scored(lm_scoring.score_documents(docs(spark, rows), target, **how))
    wanted = sorted(((repr(i), *w[1:]) for (i, _), w in zip(rows, brute(rows, {92, 6}))), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[2:] == (None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], rel=1e-9)
    of = {g[0]: g for g in got}
    assert of["90"][2] < of["91"][2] - 1
