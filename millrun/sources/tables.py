"""Batch sources and sinks.

Parquet is the at-rest format of every layer. Readers select the needed
columns right at the scan so the parquet reader only decodes those
(``ReadSchema`` in the plan), and filters written after them reach the
scan as ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the input tables the jobs read (as a catalog would
# hold them): reading with a schema skips the footer-inference job at
# planning time.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with a declared schema as a stream of its files. The path is a
    pattern (of one name): a file source takes a single file by pattern only."""
    return spark.readStream.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_json_text(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited records as one ``value`` string column (the same
    shape a message-queue source gives after ``CAST(value AS STRING)``)."""
    return spark.read.text(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_topics(messages: DataFrame, path: str) -> None:
    """Fact messages (topic, value) as JSON files, one folder per topic —
    the file form of a message sink whose topic is chosen per record."""
    messages.write.mode("overwrite").partitionBy("topic").json(path)


def load_side(spark: SparkSession, place: str, schema=None) -> DataFrame:
    """A rule or dim table from a Parquet path, or from a database as
    ``jdbc:<url>#<table>`` (its columns cast to ``schema``'s types)."""
    if not place.startswith("jdbc:"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(place)
    url, _, table = place.rpartition("#")
    if not url or not table:
        raise ValueError(f"expected jdbc:<url>#<table>, got {place!r}")
    rows = spark.read.format("jdbc").option("url", url).option("dbtable", table).load()
    return rows if schema is None else rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
