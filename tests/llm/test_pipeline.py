from inputs import FOLDER, ODD, docs
from test_decontaminate import brute as hits
from test_packing import check_pieces
from test_simhash import brute as groups
from test_suffix_dedup import brute as cuts

import corpus_pipeline
from shelfmark.llm import toxicity


def by_hand(spark, documents, folder):
    """The stages after the classifier, by brute force."""
    smallest = {c for _, _, c in groups(documents)}
    documents = [(i, t) for i, t in documents if str(i) in smallest]
    cut = cuts([t for _, t in documents])
    documents = [(i, kept.decode(errors="ignore")) for (i, _), (_, _, _, kept) in zip(documents, cut)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    return [(i, t) for i, t in documents if not hits(t, items)[1]]


def test_run_against_brute_force(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = documents.where(toxicity.toxicity(documents, "text", model) < 0.7).collect()
    left = by_hand(spark, [(r.doc_id, r.text) for r in clean], FOLDER)
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    check_pieces(rows, left, 2048)
    assert 0 < len(left) < documents.count()


def test_stages_on_odd_and_empty_documents(spark):
    for rows in (ODD, []):
        now = docs(spark, rows)
        names = now.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, FOLDER)
            assert now.columns == names
        assert corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).count() >= bool(rows)
