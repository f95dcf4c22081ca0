"""From raw documents to packed sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import best_two_fit, decontaminate, simhash, suffix_dedup, toxicity
from shelfmark.llm.queries import tokenizer_path
from shelfmark.sources.shared import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier learns from the folder's labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.toxicity(docs, "text", model) < toxicity.THRESHOLD)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group."""
    return simhash.without_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their long repeats. A character of which a byte went is left out whole.

    Every document stays, also one with nothing left; ``n_chars`` counts what is left of it. A
    null text stays null.
    """
    cut = suffix_dedup.with_repeats_removed(docs, as_text=True)
    row = F.col("row")
    shorter = F.col("cut.n_removed") > 0
    changed = {
        "text": F.when(shorter, F.col("cut.kept")).otherwise(row.getField("text")),
    }
    changed["n_chars"] = F.when(shorter, F.length(changed["text"]).cast("long")).otherwise(row.getField("n_chars"))
    return cut.select(*(changed.get(n, row.getField(n)).alias(n) for n in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document left."""
    return best_two_fit.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# Not expressible in SQL: a fitted classifier, fingerprints and a packing. Tested by brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
