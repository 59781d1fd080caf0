"""ODS text -> typed records, with a dead-letter split.

A record the source design would crash on (malformed JSON, no ``common``
object, no key, an unreadable time) gets a ``dead_reason`` instead; the
caller sends those rows to a dead-letter output and keeps going.
Columns other than the text (Kafka offset, partition, ...) pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrun.functions.jsonfn import CORRUPT, json_map, parse_json
from millrun.functions.timefn import epoch_ms_to_date, text_to_ts
from millrun.sources.shapes import CHANGE_RECORD, EQUIPMENT_LOG, INSPECT_INFO, MANUFACTURE_LOG


def select_once(df: DataFrame, *cols: Column) -> DataFrame:
    """``df.select(*cols)`` evaluated exactly once per row, as a one-row
    generator. A later filter on these columns cannot be pushed below a
    Generate; below a plain projection Catalyst would inline an expensive
    expression (a JSON parse) into the filter and evaluate it twice per
    record — and ahead of any repartition placed before it."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def _parse(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    passthrough = [c for c in df.columns if c != text]
    parsed = select_once(
        df,
        *[F.col(c) for c in passthrough],
        F.col(text).alias("raw"),
        parse_json(text, schema).alias("_r"),
    )
    fields = [f.name for f in schema.fields if f.name not in passthrough]
    return parsed.select(
        *passthrough,
        "raw",
        *[F.col(f"_r.{n}").alias(n) for n in fields],
        F.col(f"_r.{CORRUPT}").alias(CORRUPT),
    )


def parse_equipment_logs(df: DataFrame, text: str = "value") -> DataFrame:
    """Equipment log text -> common/start/log_type + ``part_id``,
    ``is_new``, ``log_ts``, ``log_date`` and ``dead_reason``."""
    p = _parse(df, text, EQUIPMENT_LOG)
    log_ts = text_to_ts(F.col("common.ts"))
    p = p.select(
        "*",
        F.col("common.part_id").alias("part_id"),
        F.col("common.is_new").alias("is_new"),
        log_ts.alias("log_ts"),
    ).withColumn("log_date", F.to_date("log_ts"))
    reason = (
        F.when(F.col("raw").isNull(), F.lit("null_record"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .when(F.col("common").isNull(), F.lit("no_common"))
        .when(F.col("part_id").isNull(), F.lit("no_part_id"))
        .when(F.col("log_ts").isNull(), F.lit("bad_ts"))
    )
    return p.withColumn("dead_reason", reason).drop(CORRUPT)


def parse_manufacture_logs(df: DataFrame, text: str = "value") -> DataFrame:
    """Manufacture log text -> ``part_id`` (from common.partId), ``ts``
    epoch ms, ``mdate`` and ``dead_reason``."""
    p = _parse(df, text, MANUFACTURE_LOG)
    p = p.withColumn("part_id", F.col("common.partId")).withColumn("mdate", epoch_ms_to_date("ts"))
    reason = (
        F.when(F.col("raw").isNull(), F.lit("null_record"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .when(F.col("common").isNull(), F.lit("no_common"))
        .when(F.col("part_id").isNull(), F.lit("no_part_id"))
        .when(F.col("ts").isNull(), F.lit("bad_ts"))
    )
    return p.withColumn("dead_reason", reason).drop(CORRUPT)


def parse_change_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Change-capture text -> table/type/ts/data (``data`` as an open
    string map). Validity (non-empty data) is checked by routing."""
    p = _parse(df, text, CHANGE_RECORD)
    reason = (
        F.when(F.col("raw").isNull(), F.lit("null_record"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
    )
    return p.withColumn("dead_reason", reason).drop(CORRUPT)


def parse_records(df: DataFrame, schema: T.StructType, key: str, text: str = "value") -> DataFrame:
    """Text -> a fixed record shape (inspection info/detail, ...): the
    schema's fields plus ``dead_reason`` (malformed, or no ``key``)."""
    p = _parse(df, text, schema)
    reason = (
        F.when(F.col("raw").isNull(), F.lit("null_record"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .when(F.col(key).isNull(), F.lit(f"no_{key}"))
    )
    return p.withColumn("dead_reason", reason).drop(CORRUPT)


def parse_inspections(df: DataFrame, text: str = "value") -> DataFrame:
    """Inspection info/detail text -> ``orderId``, ``ts`` (epoch ms)."""
    return parse_records(df, INSPECT_INFO, "orderId", text)


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dead_reason").isNull()).drop("dead_reason")


def dead(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dead_reason").isNotNull())


__all__ = [
    "parse_equipment_logs",
    "parse_manufacture_logs",
    "parse_change_records",
    "parse_records",
    "parse_inspections",
    "good",
    "dead",
    "json_map",
    "select_once",
]
