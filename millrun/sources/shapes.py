"""Record shapes of the warehouse layers as Spark schemas.

The source design treats most records as schemaless JSON; here the envelope
fields the jobs read are fixed and everything open stays a
``map<string,string>`` (or the raw text, kept beside the parsed row).
Numbers in text fields are declared ``string`` so that ``1`` and ``"1"``
read alike.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

# ODS equipment log: {"common": {...}, "start": {...}, ...}
EQUIPMENT_LOG = T.StructType(
    [
        T.StructField(
            "common",
            T.StructType(
                [
                    T.StructField("part_id", S),
                    T.StructField("is_new", S),
                    T.StructField("ts", S),
                    T.StructField("equipment_id", S),
                ]
            ),
        ),
        T.StructField("start", T.MapType(S, S)),
        T.StructField("log_type", S),
        T.StructField("seq", L),
    ]
)

# DWD manufacture log: {"common": {"partId": ...}, "ts": <epoch ms>}
MANUFACTURE_LOG = T.StructType(
    [
        T.StructField("common", T.StructType([T.StructField("partId", S)])),
        T.StructField("ts", L),
        T.StructField("seq", L),
    ]
)

# ODS change record from the database capture.
CHANGE_RECORD = T.StructType(
    [
        T.StructField("table", S),
        T.StructField("type", S),
        T.StructField("ts", L),
        T.StructField("seq", L),
        T.StructField("data", T.MapType(S, S)),
    ]
)

# Rule table (table_process). ``rule_order`` breaks ties between duplicate
# (source_table, operate_type) rows: the highest wins.
RULE = T.StructType(
    [
        T.StructField("source_table", S),
        T.StructField("operate_type", S),
        T.StructField("sink_type", S),
        T.StructField("sink_table", S),
        T.StructField("sink_columns", S),
        T.StructField("pk_column", S),
        T.StructField("sink_extend", S),
        T.StructField("rule_order", L),
    ]
)

INSPECT_INFO = T.StructType([T.StructField("orderId", S), T.StructField("ts", L)])
INSPECT_DETAIL = T.StructType([T.StructField("orderId", S), T.StructField("ts", L)])

# Inspection event feeding the size statistics.
INSPECTION_EVENT = T.StructType(
    [
        T.StructField("mid", S),
        T.StructField("size_id", S),
        T.StructField("isNew", S),
        T.StructField("isPass", S),
        T.StructField("ts", L),
    ]
)

# Production dim: production id -> equipment, factory, process type, line.
PRODUCTION_DIM = T.StructType(
    [
        T.StructField("id", S),
        T.StructField("eId", S),
        T.StructField("Fid", S),
        T.StructField("mType", S),
        T.StructField("lid", S),
    ]
)

# The five measures of the size statistics, in output order.
MEASURES = ["defect_sum", "check_sum", "defect_type_count", "double_sum", "double_fail_sum"]

# Start-log types and their routes. "WeldRobot_Start" is the
# side-output tag name, "WeldRobotStart" the label matched; both are accepted.
START_ROUTES = {
    "MachineTool_Start": "machine_start",
    "WeldRobotStart": "weld_start",
    "WeldRobot_Start": "weld_start",
}

# Declared log streams, selected by a top-level ``log_type``.
LOG_TYPE_ROUTES = {
    "shutdown": "shutdown",
    "heartbeat": "heartbeat",
    "manufacture": "manufacture",
    "manufacture_detail": "manufacture_detail",
    "large_part_progress": "large_part_progress",
}
