"""Routing of ODS records (DWD layer).

Two kinds of split, both as a ``route`` column on one DataFrame (the
Spark form of side outputs): callers ``filter`` per output, or fan out in
``foreachBatch`` after one ``persist``.

* Static split of equipment logs by start type / log type.
* Rule-driven split of database change records: the rule table decides,
  per (source table, operation), whether a record is a fact (message
  sink), a dim row (upsert sink) or undeliverable (dead letter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrun.functions.jsonfn import map_text_length
from millrun.operators.keyed import bounded_broadcast, last_per_key
from millrun.sources.shapes import LOG_TYPE_ROUTES, START_ROUTES

RULE_MAX_ROWS = 100_000

# Sink types of the rule table (compared ignoring case).
FACT_SINK = "kafka"
DIM_SINK = "hbase"


def start_type(df: DataFrame, start: str = "start") -> DataFrame:
    """``start_type`` = start["type"] when ``start`` is a non-empty object."""
    m = F.col(start)
    return df.withColumn(
        "start_type", F.when(m.isNotNull() & (F.size(m) > 0), m.getItem("type"))
    )


def route_of(start_type: Column, log_type: Column) -> Column:
    """machine_start / weld_start from the start type, else the declared
    log stream named by ``log_type``, else NULL (main output only)."""
    route = F.lit(None).cast("string")
    for name, target in reversed(list(LOG_TYPE_ROUTES.items())):
        route = F.when(log_type == name, F.lit(target)).otherwise(route)
    for name, target in reversed(list(START_ROUTES.items())):
        route = F.when(start_type == name, F.lit(target)).otherwise(route)
    return route


def with_route(df: DataFrame, start: str = "start", log_type: str = "log_type") -> DataFrame:
    """Add ``start_type`` and ``route``. Every row stays in the frame: the
    main output keeps everything, side outputs are ``route`` filters."""
    staged = start_type(df, start)
    return staged.withColumn("route", route_of(F.col("start_type"), F.col(log_type)))


def power_of(route: str) -> Column:
    """What a record says of its machine's power: ``start``, ``shutdown``, or NULL."""
    return F.when(F.col(route).isin(*sorted(set(START_ROUTES.values()))), "start").when(F.col(route) == "shutdown", "shutdown")


def route_counts(routed: DataFrame) -> DataFrame:
    """Rows per side output plus the main output (all rows), in one pass:
    a rollup gives each route's count and the grand total together."""
    r = routed.rollup("route").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.grouping_id().alias("_g")
    )
    return r.filter((F.col("_g") == 1) | F.col("route").isNotNull()).select(
        F.when(F.col("_g") == 1, F.lit("main")).otherwise(F.col("route")).alias("route"), "n"
    )


# ---------------------------------------------------------------- change log


def valid_changes(cdc: DataFrame) -> DataFrame:
    """Keep records with a table name and a non-empty ``data`` object.
    ``{}`` and ``{"a": null}`` are empty (their compact text is 2 chars)."""
    return cdc.filter(
        F.col("table").isNotNull()
        & F.col("data").isNotNull()
        & (map_text_length("data") > 3)
    )


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Normalise the rule table: one row per (source_table, operate_type)
    — the highest ``rule_order`` wins — with lower-case sink kind, default
    pk ``id``, the trimmed column list, and a validation message."""
    if "rule_order" not in rules.columns:
        rules = rules.withColumn("rule_order", F.lit(0).cast("bigint"))
    latest = last_per_key(rules, ["source_table", "operate_type"], ["rule_order"])
    cols = F.filter(
        F.transform(F.split(F.coalesce(F.col("sink_columns"), F.lit("")), ","), lambda c: F.trim(c)),
        lambda c: c != "",
    )
    pk = F.coalesce(F.nullif(F.trim(F.col("pk_column")), F.lit("")), F.lit("id"))
    kind = F.lower(F.col("sink_type"))
    return latest.select(
        "source_table",
        "operate_type",
        "sink_table",
        "sink_extend",
        "rule_order",
        kind.alias("sink_kind"),
        pk.alias("pk_column"),
        cols.alias("sink_columns"),
        F.when(
            (kind == DIM_SINK) & ~F.array_contains(cols, pk),
            F.concat(F.lit("pk column "), pk, F.lit(" not in sink_columns")),
        ).alias("rule_error"),
    )


def route_changes(cdc: DataFrame, rules: DataFrame, rule_rows: int | None = None) -> DataFrame:
    """Valid change records joined to their rule (exact (table, type)
    match). Adds ``sink_table``, ``pk_column``, ``sink_columns`` and
    ``route`` in {fact, dim, dead} with a ``reason`` for dead rows.
    ``rule_rows`` is the rule count when the caller knows it (a literal
    table); otherwise the rules are counted before being broadcast."""
    if rule_rows is not None and rule_rows <= RULE_MAX_ROWS:
        prepared = F.broadcast(prepare_rules(rules))
    else:
        prepared = bounded_broadcast(prepare_rules(rules), RULE_MAX_ROWS)
    joined = valid_changes(cdc).join(
        prepared,
        (F.col("table") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        "left",
    )
    no_pk = (F.col("sink_kind") == DIM_SINK) & F.element_at("data", F.col("pk_column")).isNull()
    route = (
        F.when(F.col("source_table").isNull(), F.lit("dead"))
        .when(F.col("rule_error").isNotNull(), F.lit("dead"))
        .when(no_pk, F.lit("dead"))
        .when(F.col("sink_kind") == FACT_SINK, F.lit("fact"))
        .when(F.col("sink_kind") == DIM_SINK, F.lit("dim"))
        .otherwise(F.lit("dead"))
    )
    reason = (
        F.when(F.col("source_table").isNull(), F.lit("no_rule"))
        .when(F.col("rule_error").isNotNull(), F.col("rule_error"))
        .when(no_pk, F.lit("no_pk"))
        .when(
            ~F.coalesce(F.col("sink_kind"), F.lit("")).isin(FACT_SINK, DIM_SINK),
            F.lit("unknown_sink_type"),
        )
    )
    return joined.withColumn("route", route).withColumn("reason", reason).drop(
        "source_table", "operate_type", "rule_order", "rule_error"
    )


def unroutable_counts(routed: DataFrame) -> DataFrame:
    """Dead-letter summary: records without a rule, per (table, type)."""
    return (
        routed.filter(F.col("reason") == "no_rule")
        .groupBy("table", "type")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )


def fact_messages(routed: DataFrame) -> DataFrame:
    """Fact output: topic = sink_table, value = the ``data`` object as JSON
    without its null members."""
    return routed.filter(F.col("route") == "fact").select(
        F.col("sink_table").alias("topic"),
        F.to_json(F.map_filter("data", lambda k, v: v.isNotNull())).alias("value"),
        "seq",
    )
