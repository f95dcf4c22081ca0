"""The queries of this subpackage over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from . import (
    best_two_fit, decontaminate, graph_search, license_scan, lm_scoring, packed_ids, periodic_runs, ring_shards,
    simhash, suffix_dedup, toxicity, warc, whitening,
)

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where this machine has a public tokenizer; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Packed id matrix of all documents."""
    return packed_ids.pack_ids(_table(spark, folder, "documents"), tokenizer_path())


def op2_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of every document under a model of those labelled good and one of all."""
    good = _table(spark, folder, "labels").where("quality = 1")
    return lm_scoring.score_documents(_table(spark, folder, "documents"), good)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document; fitted on labels outside the held-out third."""
    docs = _table(spark, folder, "documents")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    learned = _table(spark, folder, "labels").where(third != 1)
    model = toxicity.fit(docs, learned)
    scored = docs.select(
        "doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"),
        toxicity.toxicity(docs, "text", model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op4_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document."""
    return best_two_fit.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without its long repeats."""
    cut = suffix_dedup.with_repeats_removed(_table(spark, folder, "documents"))
    return cut.select(
        "row.doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256")
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and passages in every document."""
    found = license_scan.scan_licenses(_table(spark, folder, "documents"))
    return found.withColumns({
        "base_labels": F.concat_ws(",", "base_labels"), "labels": F.concat_ws(",", "labels"),
    })


def op7_graph_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = _table(spark, folder, "embeddings")
    index = graph_search.build_index(vectors)
    return graph_search.search_index(index, vectors.where("vec_id % 20 = 0"))


def op8_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document: counts of shards are at most one apart."""
    placed = ring_shards.shard_documents(_table(spark, folder, "documents"))
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op9_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit",
        # As in the SQL, items without an id count as one.
        (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back, equal payloads once."""
    path = fresh_path(spark, "warc")
    warc.archive_pages(_table(spark, folder, "pages"), path)
    return warc.archived_pages(spark, path)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the four strongest components."""
    vectors = _table(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text; those of a tenth of all ids repeat a stretch of themselves from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, some made periodic, and what is left of it without them."""
    found = periodic_runs.find_runs(_table(spark, folder, "documents"), rewrite=looped)
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_packed_ids": op1_packed_ids,
    "op2_cross_entropy": op2_cross_entropy,
    "op3_toxicity": op3_toxicity,
    "op4_best_two_fit": op4_best_two_fit,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_graph_search": op7_graph_search,
    "op8_ring_shards": op8_ring_shards,
    "op9_wu_manber": op9_wu_manber,
    "op10_simhash": op10_simhash,
    "op11_warc": op11_warc,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
# Five hexadecimal digits are four characters of base 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {start}, 5) AS BIGINT) >> {shift}) & 31), 1)"
    for start in range(1, 41, 5) for shift in (15, 10, 5, 0)
)
# The others have no SQL: tokenizers, fitted models, XXH64, packing and graph search are beyond it,
# and 400-byte windows or all lags of all texts too slow. They are tested against brute force.
ORACLES = {
    "op11_warc": f"""
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = least_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least_id THEN NULL ELSE least_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least_id FROM pages)""",
    "op9_wu_manber": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS body
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS body
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d CROSS JOIN sizes)),
hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, body)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS found
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(found, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
