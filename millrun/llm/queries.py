"""The registered queries of this folder, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, decontamination, hamming, hard_negatives, inverted_index, language_id, packing, simhash, substrings, surrogates, token_file, toxicity
from .common import scratch, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file (the package is installed on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").select("vec_id", hamming.sign_code("embedding").alias("code"))
    return hamming.top_k(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Keys are secrets of a run; this one makes the registered results repeatable.
SURROGATE_KEY = "registered-queries"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymize(table(spark, sf_dir, "documents"), SURROGATE_KEY, count_col="n_entities")


def op5_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return inverted_index.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, distance=3, seed=42)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.of_documents(table(spark, sf_dir, "documents"), ["doc_id"])


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over raw pages, with markup, address and hosts."""
    return language_id.of_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), ["page_id", "url"])


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_file.round_trip(docs, scratch(spark, "token-file"), tokenizer_file("word_bpe_49k.json"), end_id=1)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"), size=2048, end_id=0)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), window=10)


def decontamination_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same index, asked for windows whose words stand within 20 words of a document in any order."""
    return decontamination.decontaminate_near(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), window=10, span=20)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centres = centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=8, rounds=10, size=64, scale=1024, salt="3:")
    return centroids.with_inertia(assigned, centres)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    given = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding").withColumn("label", moved)
    rows = hard_negatives.integer_rows(given, scale=256)
    return hard_negatives.mine(rows, rows.where(F.col("id") % 100 == 0), positives=5, negatives=5, low=80, high=100, base=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hamming": op1_hamming,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_substrings": op3_substrings,
    "op4_surrogates": op4_surrogates,
    "op5_inverted_index": op5_inverted_index,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "language_id_pages": language_id_pages,
    "op9_token_file": op9_token_file,
    "op10_best_fit": op10_best_fit,
    "op11_decontamination": op11_decontamination,
    "decontamination_near": decontamination_near,
    "op12_centroids": op12_centroids,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL: dict[str, str] = {
    "op1_hamming": """
        WITH pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   len(list_filter(range(1, 65), lambda i: (q.embedding[i] > 0) <> (c.embedding[i] > 0))) AS distance
            FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance FROM ranked WHERE rank <= 10
    """,
    "op11_decontamination": decontamination.ORACLE_SQL["phrase"],
    "decontamination_near": decontamination.ORACLE_SQL["near"],
    "op12_centroids": centroids.oracle_sql(),
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
