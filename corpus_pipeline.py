"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread as the next one's input.

1. language ID: documents without an accepted language go;
2. SimHash near-dedup: one document of each group stays;
3. substring dedup: words of repeated passages go (a text without any is left as it is);
4. PII: entities get surrogates;
5. packing: the tokens of all documents in sequences of 2048.

All but the last return the columns of ``documents``; ``n_chars`` follows a
changed text. Every other column passes as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.llm import language_id, packing, simhash, substrings, surrogates
from millrun.llm.common import scratch, table
from millrun.llm.queries import SURROGATE_KEY, tokenizer_file


def _with_text(df: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """``columns`` of ``df`` with the new text where it changed, and its length."""
    new = {"text": F.when(changed, text).otherwise(F.col("text"))}
    if "n_chars" in columns:
        new["n_chars"] = F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(df.schema["n_chars"].dataType)
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, distance=3, seed=42)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substrings.deduplicate(docs, window=20, carry=tuple(docs.columns))
    return _with_text(kept, docs.columns, F.col("kept"), F.col("n_removed") > 0)


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = surrogates.pseudonymize(docs, SURROGATE_KEY, count_col="__entities")
    return _with_text(done, docs.columns, F.col("text"), F.col("__entities") > 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), size=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("simhash", near_dedup),
    ("substrings", substring_dedup),
    ("surrogates", pseudonymize),
    ("packing", pack),
]
#: Fingerprints, n-gram models and merges are nothing SQL can express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
