"""Query catalogue: each entry runs one warehouse operator (or job slice)
over the whole supplied tables through the stand-ins of ``standins.py``.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the DuckDB oracle in ``oracle.py``. Those that measure a
side before they broadcast it, cut keys by density or run a stream do that
part of their work while the frame is built.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.functions.timefn import ts_text
from millrun.operators import dims, inspect, parse, parts, rollup, routing, stats
from millrun.plans import standins as si
from millrun.plans.jobs import e1_equipment_logs
from millrun.session import checkpoint_dir
from millrun.sources.tables import read_table, stream_table
from millrun.streaming.ordered import enrich_asof_stream
from millrun.streaming.stateful import unique_part_stream
from millrun.streaming.state_reader import keyed_state

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------- E1 / E3 parts


def _equipment_logs(spark: SparkSession, sf: str) -> DataFrame:
    return parse.good(parse.parse_equipment_logs(si.equipment_log_text(spark, sf)))


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    logs = _equipment_logs(spark, sf).select("seq", "part_id", "is_new", "log_date")
    return parts.new_part_flag(logs, "part_id", "is_new", "log_date", "seq")


def q_new_part_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).select(
        F.col("seq").alias("event_id"), "part_id", "is_new", "log_date"
    )


def q_start_split(spark: SparkSession, sf: str) -> DataFrame:
    logs = _equipment_logs(spark, sf).select("start", "log_type")
    return routing.route_counts(routing.with_route(logs))


def q_part_stats(spark: SparkSession, sf: str) -> DataFrame:
    return parts.part_stats(_flagged(spark, sf), "part_id", "log_date", "is_new")


def _manufacture_logs(spark: SparkSession, sf: str) -> DataFrame:
    logs = parse.good(parse.parse_manufacture_logs(si.manufacture_log_text(spark, sf)))
    return logs.select("seq", "part_id", "mdate")


def q_unique_part(spark: SparkSession, sf: str) -> DataFrame:
    out = parts.unique_part_per_day(_manufacture_logs(spark, sf), "part_id", "mdate", "seq", mode="change")
    return out.select(F.col("seq").alias("event_id"), "part_id", "mdate")


def q_unique_part_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state that the unique-part stream keeps per part, read from its
    checkpoint once the stream has run over all events."""
    e = stream_table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd").alias("mday")
    logs = e.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("part_id"), day)
    out = unique_part_stream(logs, "part_id", "mday", "seq", cleanup=False)
    root = f"{checkpoint_dir(spark)}/part-state-{uuid.uuid4().hex}"
    run = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
    run.trigger(availableNow=True).start().awaitTermination()
    return keyed_state(spark, f"{root}/state").select("part_id", "last_day")


def q_unique_part_first(spark: SparkSession, sf: str) -> DataFrame:
    out = parts.unique_part_per_day(_manufacture_logs(spark, sf), "part_id", "mdate", "seq", mode="distinct")
    return out.select(F.col("seq").alias("event_id"), "part_id", "mdate")


def q_daily_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events", ["user_id", "ts"])
    days = e.select(F.col("user_id").cast("string").alias("part_id"), F.to_date("ts").alias("mdate"))
    return parts.daily_part_count(days, "part_id", "mdate")


# -------------------------------------------------------------- E2 routing


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_changes(si.change_records(spark, sf), si.rules(spark), len(si.RULE_ROWS))


def q_parse_filter(spark: SparkSession, sf: str) -> DataFrame:
    valid = routing.valid_changes(si.change_records(spark, sf))
    return valid.select(
        F.col("seq").alias("event_id"),
        F.col("table").alias("table_name"),
        F.col("type").alias("op"),
        F.col("data").getItem("k").alias("k"),
    )


def q_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = _routed(spark, sf).filter(F.col("route").isin("fact", "dim"))
    return routed.select(
        F.col("seq").alias("event_id"),
        F.col("table").alias("table_name"),
        F.col("type").alias("op"),
        "sink_table",
        "route",
        "pk_column",
        F.concat_ws(",", "sink_columns").alias("sink_columns"),
        F.col("data").getItem("k").alias("k"),
    )


def q_unroutable(spark: SparkSession, sf: str) -> DataFrame:
    return routing.unroutable_counts(_routed(spark, sf)).select(
        F.col("table").alias("table_name"), F.col("type").alias("op"), "n"
    )


def _dim_changes(spark: SparkSession, sf: str) -> DataFrame:
    dim_rows = _routed(spark, sf).filter(F.col("route") == "dim")
    return dims.project_data(dim_rows, ["id", "k"])


def q_dim_upsert(spark: SparkSession, sf: str) -> DataFrame:
    changes = _dim_changes(spark, sf).select("sink_table", "id", "k", "type", "seq")
    latest = dims.latest_changes(changes, ["sink_table", "id"], "seq")
    return latest.select(
        "sink_table", "id", "k", F.col("type").alias("op"), F.col("seq").alias("event_id")
    )


def q_dim_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The dim table after applying every dim-routed change to an empty
    snapshot (per-column latest write; deletes would remove keys)."""
    routed = _routed(spark, sf).filter(F.col("route") == "dim")
    changes = dims.project_data(routed, ["id", "k"], presence=True)
    snap = dims.merge_snapshot(None, changes, "id", ["id", "k"])
    return snap.select("id", "k")


def q_dim_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches (the first half of the month, the rest) into a stored
    table: updates carry one column only, deletes remove rows."""
    split = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    all_changes = si.change_records(spark, sf).select(
        F.col("data").getItem("id").alias("id"),
        F.col("data").getItem("k").alias("k"),
        F.when(F.col("type") == "insert", F.col("table")).alias("kind"),
        F.lit(True).alias("_has_k"),
        (F.col("type") == "insert").alias("_has_kind"),
        "type",
        "seq",
        "event_ts",
    )
    root = f"{checkpoint_dir(spark)}/dim-merge-{uuid.uuid4().hex}"
    for batch, part in enumerate((F.col("event_ts") < split, F.col("event_ts") >= split)):
        dims.upsert_dim(spark, all_changes.filter(part), root, "dim_user", "id", ["id", "k", "kind"], batch)
    return dims.read_snapshot(spark, root, "dim_user")


def q_fact_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Fact messages per destination topic (the per-record topic sink)."""
    facts = routing.fact_messages(_routed(spark, sf))
    return facts.groupBy("topic").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def q_fact_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every fact message with the members of its text."""
    facts = routing.fact_messages(_routed(spark, sf))
    member = lambda name: F.get_json_object("value", f"$.{name}")
    return facts.select(F.col("seq").alias("event_id"), "topic", member("id").alias("id"), member("k").alias("k"))


def q_log_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The text of every log that goes on: all members as they came, the flag corrected."""
    value = e1_equipment_logs(si.equipment_log_text(spark, sf, members=True))["main"]
    member = lambda path: F.get_json_object("value", f"$.{path}")
    return value.select(
        F.col("seq").alias("event_id"),
        member("common.part_id").alias("part_id"),
        member("common.is_new").alias("is_new"),
        member("common.reading").alias("reading"),
        member("start.type").alias("start_type"),
        member("extra.k").alias("extra_k"),
    )


def q_log_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Records per side output: starts, shutdowns, heartbeats and the three manufacture streams."""
    logs = parse.good(parse.parse_equipment_logs(si.equipment_log_text(spark, sf, log_types=True)))
    return routing.route_counts(routing.with_route(logs.select("start", "log_type")))


def power_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of a machine, with what it says of its power: start, shutdown or nothing."""
    logs = parse.good(parse.parse_equipment_logs(si.equipment_log_text(spark, sf, log_types=True)))
    routed = routing.with_route(logs.select("seq", "start", "log_type", "log_ts", F.col("common.equipment_id").alias("equipment_id")))
    return routed.select("equipment_id", F.col("log_ts").alias("ts"), "seq", routing.power_of("route").alias("power"))


def q_power_on(spark: SparkSession, sf: str) -> DataFrame:
    """Power-on sessions from start, shutdown and other records; a silence of 12 hours ends one."""
    out = stats.power_on_sessions(power_logs(spark, sf), "equipment_id", "ts", "seq", "power", "12 hours")
    return out.select("equipment_id", F.unix_micros("first_record").alias("first_us"), "n_records", "uptime_us", "opened_by", "closed_by")


def q_completion_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of every large part (order) by day from its completed steps (lines), seven planned."""
    d = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"]).select(
        F.col("l_orderkey").alias("part_id"), F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("step")
    )
    out = parts.completion_progress(parts.step_masks(d, "part_id", "day", "step", 7), "part_id", "day", 7)
    return out.select("part_id", "day", "n_records", "n_new", "n_done", F.concat_ws(",", "missing").alias("missing"), "progress")


def q_period_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Different parts per day, week and month from stored daily sketches, beside the exact counts."""
    logs = _manufacture_logs(spark, sf).select("part_id", "mdate")
    path = f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    parts.daily_part_sketches(logs).write.parquet(path)
    return parts.checked_period_parts(logs, spark.read.parquet(path))


def q_enrich_asof_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``q_enrich_asof`` as a stream: both feeds are read as streams and run until all is given out."""
    events = stream_table(spark, sf, "events")
    routed = routing.route_changes(si.change_records_of(events), si.rules(spark), len(si.RULE_ROWS))
    is_dim = F.col("route") == "dim"
    changes = routed.select(
        # a change of no dim is a tick: its time moves the feed's watermark
        F.when(is_dim, F.col("data").getItem("id").cast("bigint")).alias("id"),
        F.col("event_ts").cast("timestamp").alias("vts"),
        F.col("seq").alias("dim_seq"),
        F.col("data").getItem("k").alias("k"),
    )
    facts = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = enrich_asof_stream(facts, changes, "user_id", "ts", "id", "vts", "dim_seq", ["k"], delay="0 seconds")
    root = f"{checkpoint_dir(spark)}/asof-stream-{uuid.uuid4().hex}"
    run = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").select("event_id", "user_id", "dim_seq", "k")


def q_recheck_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The re-check feed itself: every event of a (user, type) but the first."""
    e = read_table(spark, sf, "events", ["event_id", "user_id", "event_type", "ts"])
    out = inspect.recheck_rows(e, "user_id", "event_type", ["ts", "event_id"])
    return out.select("event_id", "user_id", "event_type", "ts")


def q_enrich_asof(spark: SparkSession, sf: str) -> DataFrame:
    versions = _dim_changes(spark, sf).select(
        F.col("id").cast("bigint").alias("user_id"),
        F.col("event_ts").alias("vts"),
        F.col("seq").alias("dim_seq"),
        "k",
    )
    probes = read_table(spark, sf, "events", ["event_id", "user_id", "ts"])
    out = dims.enrich_asof(probes, versions, "user_id", "ts", "user_id", "vts", "dim_seq", ["k"])
    return out.select("event_id", "user_id", "dim_seq", "k")


def q_working_days(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events", ["event_id", "user_id", "ts"])
    start = dims.first_seen(e, "user_id", "ts")
    return dims.working_days(e, "user_id", "ts", start).select("event_id", "user_id", "working_days")


# ------------------------------------------------------ E4 inspection joins


def _interval(spark: SparkSession, sf: str, bound_ms: int) -> DataFrame:
    e = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    info = e.filter(F.col("event_type") == "click").select(
        F.col("user_id").cast("string").alias("order_id"),
        F.col("event_id").alias("info_id"),
        F.col("ts").alias("info_ts"),
    )
    detail = e.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("d_order_id"),
        F.col("event_id").alias("detail_id"),
        F.col("ts").alias("detail_ts"),
    )
    j = inspect.interval_join(
        info, detail, "order_id", "info_ts", "detail_ts", -bound_ms, bound_ms, right_key="d_order_id"
    )
    return j.select("order_id", "info_id", "detail_id", "info_ts", "detail_ts")


def q_interval_join_5s(spark: SparkSession, sf: str) -> DataFrame:
    return _interval(spark, sf, 5_000)


def q_interval_join_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _interval(spark, sf, 3_600_000)


def q_enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    out = dims.enrich(li, si.supplier_dim(spark, sf), "l_suppkey", "s_suppkey", {"s_nationkey": "fid"})
    out = dims.enrich(out, nation, "fid", "n_nationkey", {"n_name": "factory_name"})
    out = dims.enrich(out, si.part_dim(spark, sf), "l_partkey", "p_partkey", {"p_brand": "lid", "p_type": "mtype"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "fid", "factory_name", "lid", "mtype")


# ------------------------------------------------------------ E5 statistics


def _size_feeds(spark: SparkSession, sf: str, of: Callable[..., DataFrame]) -> DataFrame:
    d = si.inspection_details(spark, sf)
    keep = [F.col("mid"), F.col("size_id"), F.col("isNew").alias("isnew"), F.col("ts")]
    member = {"detail": F.lit(True), "per_size": F.col("l_returnflag") == "R", "recheck": F.col("l_linenumber") > 1}
    return of(d, member, keep)


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    return _size_feeds(spark, sf, stats.measures_once)


def _production_lookups(spark: SparkSession, sf: str):
    return [
        (si.supplier_dim(spark, sf), "mid", "s_suppkey", {"s_nationkey": "fid", "s_suppkey": "eid"}),
        (si.part_dim(spark, sf), "size_id", "p_partkey", {"p_brand": "lid", "p_type": "mtype"}),
    ]


def q_size_stats_window(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_stats_enriched(
        _measured(spark, sf), _production_lookups(spark, sf), "ts", "1 day"
    )


def q_size_stats_7d(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_stats_enriched(_measured(spark, sf), _production_lookups(spark, sf), "ts", "7 days")


def q_size_stats_coarse(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_stats_enriched(
        _measured(spark, sf), _production_lookups(spark, sf)[:1], "ts", "7 days", keys=["fid", "isnew"]
    )


def q_metric_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return _size_feeds(spark, sf, stats.normalise_once)


def q_size_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Events as inspections: 10 s sums to hours, hours to days, each by
    equipment, process, line, factory and in all. The user is production id
    and size, so ids that a dim lacks are a level's NULL."""
    e = read_table(spark, sf, "events", ["user_id", "ts", "event_type"])
    e = e.select(F.col("user_id").alias("mid"), F.col("user_id").alias("size_id"), "ts", "event_type", F.when(F.col("event_type") != "error", "1").otherwise("0").alias("isPass"))
    member = {"detail": F.lit(True), "per_size": F.col("event_type") == "error", "recheck": F.col("event_type") == "view"}
    rows = stats.measures_once(e, member, ["mid", "size_id", "ts"])
    hours, days = rollup.chained_sums(rows, _production_lookups(spark, sf), "ts", ("10 seconds", "1 hour", "1 day"))
    return rollup.by_level(hours, "hour").unionByName(rollup.by_level(days, "day"))


def q_tumbling_10s(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events", ["ts", "event_type"])
    w = e.groupBy(stats.window_start("ts", "10 seconds").alias("_ws"), "event_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n")
    )
    end = F.col("_ws") + F.expr("INTERVAL 10 seconds")
    return w.select(ts_text(F.col("_ws")).alias("wbt"), ts_text(end).alias("wet"), "event_type", "n")


def q_size_first(spark: SparkSession, sf: str) -> DataFrame:
    d = si.inspection_details(spark, sf).select(
        "mid", "size_id", "isPass", "ts", F.to_date("ts").alias("day")
    )
    first = inspect.first_defect_per_size(d, "mid", "size_id", "day", "isPass", ["ts"])
    return first.select("mid", "size_id", "day")


def q_size_recheck(spark: SparkSession, sf: str) -> DataFrame:
    d = si.inspection_details(spark, sf).select("mid", "size_id")
    return inspect.recheck_counts(d, "mid", "size_id")


def q_uptime_sessions(spark: SparkSession, sf: str) -> DataFrame:
    beats = read_table(spark, sf, "events", ["user_id", "ts"]).select(
        F.col("user_id").alias("equipment_id"), "ts"
    )
    return stats.uptime_sessions(beats, "equipment_id", "ts", "6 minutes")


QUERIES: dict[str, Query] = {
    "q_parse_filter": q_parse_filter,
    "q_new_part_flag": q_new_part_flag,
    "q_start_split": q_start_split,
    "q_route": q_route,
    "q_unroutable": q_unroutable,
    "q_dim_upsert": q_dim_upsert,
    "q_dim_snapshot": q_dim_snapshot,
    "q_fact_topics": q_fact_topics,
    "q_unique_part": q_unique_part,
    "q_unique_part_first": q_unique_part_first,
    "q_unique_part_state": q_unique_part_state,
    "q_daily_parts": q_daily_parts,
    "q_interval_join_5s": q_interval_join_5s,
    "q_interval_join_1h": q_interval_join_1h,
    "q_enrich_left": q_enrich_left,
    "q_enrich_asof": q_enrich_asof,
    "q_working_days": q_working_days,
    "q_size_stats_window": q_size_stats_window,
    "q_size_stats_7d": q_size_stats_7d,
    "q_size_stats_coarse": q_size_stats_coarse,
    "q_size_rollup": q_size_rollup,
    "q_tumbling_10s": q_tumbling_10s,
    "q_metric_normalise": q_metric_normalise,
    "q_size_first": q_size_first,
    "q_size_recheck": q_size_recheck,
    "q_part_stats": q_part_stats,
    "q_uptime_sessions": q_uptime_sessions,
    "q_fact_messages": q_fact_messages,
    "q_dim_merge": q_dim_merge,
    "q_log_texts": q_log_texts,
    "q_recheck_rows": q_recheck_rows,
    "q_log_routes": q_log_routes,
    "q_power_on": q_power_on,
    "q_completion_progress": q_completion_progress,
    "q_period_parts": q_period_parts,
    "q_enrich_asof_stream": q_enrich_asof_stream,
}
