"""Stand-ins: the supplied test tables dressed as warehouse records.

``events`` (already in time order by ``event_id``) plays the equipment
log, the manufacture log and the change-capture stream; ``lineitem`` plays
the inspection details; ``supplier`` and ``part`` the production dims.
The mapping (fixed, mirrored in ``oracle.py``):

* part := user_id; seq := event_id; raw is_new := "0" for ``error``
  events, else "1"; start type := MachineTool_Start for ``signup``,
  WeldRobotStart for ``click``, an empty start object for ``view``.
* log type (where written): shutdown := ``error``, heartbeat := ``view``,
  the three manufacture streams := ``purchase`` by event_id mod 3.
* change record: table := event_type; operation := delete / update /
  insert for event_id mod 4 = 3 / 2 / other; data := ``props`` JSON plus
  ``id`` := user_id.
* inspection detail: mid := l_suppkey, size id := l_partkey, isPass :=
  "1" unless l_returnflag = 'R', isNew := l_linestatus, ts := l_shipdate;
  per-size feed := rows with l_returnflag = 'R'; re-check feed :=
  l_linenumber > 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.functions.jsonfn import json_map
from millrun.operators.parse import select_once
from millrun.sources.shapes import RULE
from millrun.sources.tables import read_table

# The rule table of the stand-in (source table, operation,
# sink type, sink table, sink columns, pk column, sink extend, order).
RULE_ROWS = [
    ("purchase", "insert", "kafka", "dwd_purchase", "id,k", "", None, 1),
    ("purchase", "update", "KAFKA", "dwd_purchase", "id,k", None, None, 1),
    ("view", "insert", "kafka", "dwd_view", "id, k", None, None, 1),
    ("signup", "insert", "hbase", "dim_user", "id,k", " ", None, 1),
    ("signup", "update", "HBASE", "dim_user", " id , k ", "id", None, 1),
]


def rules(spark: SparkSession) -> DataFrame:
    """The rule table as JVM-side literals (a local relation, no Python
    round trip per job)."""
    rows = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, RULE.fields)])
        for row in RULE_ROWS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _events(spark: SparkSession, sf: str, cols: list[str]) -> DataFrame:
    """Events as the record stream of a topic."""
    return read_table(spark, sf, "events", cols)


def operation(event_id: str = "event_id"):
    m = F.pmod(F.col(event_id), F.lit(4))
    return F.when(m == 3, "delete").when(m == 2, "update").otherwise("insert")


def equipment_log_text(spark: SparkSession, sf: str, members: bool = False, log_types: bool = False) -> DataFrame:
    """ODS equipment-log text (``value``) with its arrival ``seq``; with
    ``members`` it also has some that no job knows: a number in ``common``
    and an object of its own. With ``log_types`` records name their
    equipment and the log stream they belong to: shutdown := ``error``,
    heartbeat := ``view``, and ``purchase`` by event_id mod 3 a manufacture
    record, a manufacture detail or a large part's progress."""
    e = _events(spark, sf, ["event_id", "ts", "user_id", "event_type", *(["value", "props"] if members else [])])
    start = (
        F.when(F.col("event_type") == "signup", F.create_map(F.lit("type"), F.lit("MachineTool_Start")))
        .when(F.col("event_type") == "click", F.create_map(F.lit("type"), F.lit("WeldRobotStart")))
        .when(F.col("event_type") == "view", F.create_map().cast("map<string,string>"))
    )
    common = F.struct(
        F.col("user_id").cast("string").alias("part_id"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(1)).alias("is_new"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        *([F.floor("value").alias("reading")] if members else []),
        *([F.col("user_id").cast("string").alias("equipment_id")] if log_types else []),
    )
    third = F.pmod(F.col("event_id"), F.lit(3))
    log_type = (
        F.when(F.col("event_type") == "error", "shutdown")
        .when(F.col("event_type") == "view", "heartbeat")
        .when(F.col("event_type") == "purchase", F.when(third == 0, "manufacture").when(third == 1, "manufacture_detail").otherwise("large_part_progress"))
    )
    extra = [json_map("props").alias("extra")] if members else []
    return e.select(
        F.col("event_id").alias("seq"),
        F.to_json(F.struct(common.alias("common"), start.alias("start"), *([log_type.alias("log_type")] if log_types else []), *extra)).alias("value"),
    )


def manufacture_log_text(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf, ["event_id", "ts", "user_id"])
    body = F.struct(
        F.struct(F.col("user_id").cast("string").alias("partId")).alias("common"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )
    return e.select(F.col("event_id").alias("seq"), F.to_json(body).alias("value"))


def change_records(spark: SparkSession, sf: str, event_types: list[str] | None = None) -> DataFrame:
    """Parsed change records: table, type, ts (epoch ms), seq, data map."""
    e = _events(spark, sf, ["event_id", "ts", "user_id", "event_type", "props"])
    if event_types:
        e = e.filter(F.col("event_type").isin(*event_types))
    return change_records_of(e)


def change_records_of(e: DataFrame) -> DataFrame:
    """The change records of ``events`` rows, a batch or a stream."""
    data = F.map_concat(
        F.create_map(F.lit("id"), F.col("user_id").cast("string")), json_map("props")
    )
    return select_once(
        e,
        F.col("event_type").alias("table"),
        operation().alias("type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("props").isNotNull(), data).alias("data"),
        F.col("ts").alias("event_ts"),
    )


def inspection_details(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(
        spark,
        sf,
        "lineitem",
        ["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_linenumber"],
    )
    return li.select(
        F.col("l_suppkey").alias("mid"),
        F.col("l_partkey").alias("size_id"),
        F.when(F.col("l_returnflag") != "R", F.lit("1")).otherwise(F.lit("0")).alias("isPass"),
        F.col("l_linestatus").alias("isNew"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_returnflag"),
        F.col("l_linenumber"),
    )


def inspection_feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(detail, per-size, re-check) feeds."""
    d = inspection_details(spark, sf)
    return d, d.filter(F.col("l_returnflag") == "R"), d.filter(F.col("l_linenumber") > 1)


def supplier_dim(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])


def part_dim(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
