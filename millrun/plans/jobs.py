"""The warehouse jobs in batch form (replays, backfills, tests).

Each job takes the layer's input DataFrame(s) and returns named outputs
(lazy DataFrames); ``write_outputs`` stores them as parquet folders. The
streaming drivers in ``millrun.streaming.jobs`` run the same operators
per micro-batch or with per-key state.

E1 equipment logs  -> parse, new-part flag, start/log-type split
E2 change records  -> rule routing: facts, dim upserts, dead letters
E3 manufacture log -> first record of a part per day (+ daily count)
E4 inspections     -> interval join of header and detail, equipment lookup
E5 size statistics -> three feeds, union, production dims, window sums
E6 part statistics -> per part and day counts from E1's output
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.functions.jsonfn import with_member
from millrun.functions.timefn import epoch_ms_to_ts
from millrun.operators import dims, inspect, parse, parts, routing, stats


def e1_equipment_logs(text: DataFrame, text_col: str = "value") -> dict[str, DataFrame]:
    parsed = parse.parse_equipment_logs(text, text_col)
    good = parse.good(parsed)
    flagged = parts.new_part_flag(good, "part_id", "is_new", "log_date", "seq")
    routed = routing.with_route(flagged)
    # the whole record goes on; only a corrected flag changes it
    kept = F.col("common.is_new").eqNullSafe(F.col("is_new"))
    routed = routed.withColumn("value", F.when(kept, F.col("raw")).otherwise(with_member("raw", "common", "is_new", F.col("is_new"))))
    out = {"main": routed, "dead_letter": parse.dead(parsed)}
    for route in ("machine_start", "weld_start", "shutdown", "heartbeat", "manufacture",
                  "manufacture_detail", "large_part_progress"):
        out[route] = routed.filter(F.col("route") == route)
    return out


def e2_change_records(cdc: DataFrame, rules: DataFrame) -> dict[str, DataFrame]:
    """Parsed change records (with ``dead_reason`` when they come from
    text) -> facts, dim changes, dead letters (no rule / bad rule) and
    records that could not be parsed."""
    malformed = None
    if "dead_reason" in cdc.columns:
        malformed = parse.dead(cdc)
        cdc = parse.good(cdc)
    routed = routing.route_changes(cdc, rules)
    out = {
        "facts": routing.fact_messages(routed),
        "dim_changes": routed.filter(F.col("route") == "dim"),
        "dead_letter": routed.filter(F.col("route") == "dead"),
        "unroutable": routing.unroutable_counts(routed),
    }
    if malformed is not None:
        out["malformed"] = malformed.select("raw", "dead_reason")
    return out


def e2_apply_dims(
    spark: SparkSession, dim_changes: DataFrame, rules: DataFrame, root: str, version: int,
    deletes: str = "remove", run: str = "",
) -> list[str]:
    """Upsert the dim rows of batch ``version`` of ``run`` into their tables.
    The rule table is small configuration (at most ``RULE_MAX_ROWS``), so its
    dim rules are listed on the driver."""
    prepared = routing.prepare_rules(rules).filter(
        (F.col("sink_kind") == routing.DIM_SINK) & F.col("rule_error").isNull()
    )
    # One upsert per dim table: the rules that feed it (insert, update, ...)
    # may list different columns; the table gets their union, in order.
    tables: dict[str, tuple[str, list[str]]] = {}
    listed = prepared.select("sink_table", "pk_column", "sink_columns").limit(routing.RULE_MAX_ROWS + 1).collect()
    if len(listed) > routing.RULE_MAX_ROWS:
        raise ValueError(f"more than {routing.RULE_MAX_ROWS} dim rules")
    for r in listed:
        pk, cols = tables.get(r["sink_table"], (r["pk_column"], []))
        if pk != r["pk_column"]:
            raise ValueError(f"rules for {r['sink_table']} name two pk columns: {pk}, {r['pk_column']}")
        tables[r["sink_table"]] = (pk, cols + [c for c in r["sink_columns"] if c not in cols])
    for sink_table, (pk, cols) in sorted(tables.items()):
        dims.ensure_dim_table(spark, root, sink_table, cols, pk)
        changes = dims.project_data(dim_changes.filter(F.col("sink_table") == sink_table), cols, presence=True)
        dims.upsert_dim(spark, changes, root, sink_table, pk, cols, version, deletes=deletes, run=run)
    return sorted(tables)


def e3_unique_parts(text: DataFrame, mode: str = "change", text_col: str = "value") -> dict[str, DataFrame]:
    parsed = parse.parse_manufacture_logs(text, text_col)
    good = parse.good(parsed)
    unique = parts.unique_part_per_day(good, "part_id", "mdate", "seq", mode=mode).withColumn("value", F.col("raw"))
    return {
        "unique_part": unique,
        "daily_parts": parts.daily_part_count(unique, "part_id", "mdate"),
        "dead_letter": parse.dead(parsed),
    }


def e4_inspection_wide(
    info: DataFrame,
    detail: DataFrame,
    equipment: DataFrame | None = None,
    lower_ms: int = -5000,
    upper_ms: int = 5000,
) -> DataFrame:
    """info(orderId, ts ms, ...) x detail(orderId, ts ms, ...) within the
    bounds; the equipment dim adds ``start_date`` and working days."""
    i = info.select(*[F.col(c).alias(f"info_{c}") for c in info.columns]).withColumn(
        "info_time", epoch_ms_to_ts("info_ts")
    )
    d = detail.select(*[F.col(c).alias(f"detail_{c}") for c in detail.columns]).withColumn(
        "detail_time", epoch_ms_to_ts("detail_ts")
    )
    wide = inspect.interval_join(
        i, d, "info_orderId", "info_time", "detail_time", lower_ms, upper_ms, right_key="detail_orderId"
    )
    if equipment is not None and "detail_equipmentId" in wide.columns:
        wide = dims.enrich(wide, equipment, "detail_equipmentId", "id", {"start_date": "equipment_start"})
        wide = wide.withColumn(
            "working_days", F.datediff(F.to_date("detail_time"), F.col("equipment_start")).cast("bigint")
        )
    return wide


def e5_size_stats(
    detail: DataFrame,
    per_size: DataFrame,
    recheck: DataFrame,
    production: DataFrame,
    window: str = "10 seconds",
) -> DataFrame:
    """Feeds carry (mid, isNew, isPass, ts ms); ``production`` is the dim
    (id, eId, Fid, mType, lid)."""
    keep = [F.col("mid"), F.col("isNew").alias("isnew"), epoch_ms_to_ts("ts").alias("ts")]
    feeds = stats.union_feeds(
        stats.normalise(detail, "detail", keep),
        stats.normalise(per_size, "per_size", keep),
        stats.normalise(recheck, "recheck", keep),
    )
    lookup = [(production, "mid", "id", {"Fid": "fid", "lid": "lid", "mType": "mtype", "eId": "eid"})]
    return stats.size_stats_enriched(feeds, lookup, "ts", window, grain=("mid", "isnew"))


def e6_part_stats(flagged: DataFrame) -> DataFrame:
    return parts.part_stats(flagged, "part_id", "log_date", "is_new")


def write_outputs(outputs: Mapping[str, DataFrame], root: str) -> None:
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


__all__ = [
    "e1_equipment_logs",
    "e2_change_records",
    "e2_apply_dims",
    "e3_unique_parts",
    "e4_inspection_wide",
    "e5_size_stats",
    "e6_part_stats",
    "write_outputs",
]
