"""The warehouse jobs as Structured Streaming queries.

Builders (``*_stream``) turn input streams into the output stream and are
side-effect free; ``start_*`` attach the sinks (checkpoint under the
shared folder, trigger interval from the job's design). Sources are any
streaming DataFrame with a ``value`` text column and a ``seq`` arrival
order (message-queue offset); tests feed JSON files.

Delivery: file sinks are exactly-once; ``foreachBatch`` outputs are
written per batch id with overwrite, so a replayed batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.functions.jsonfn import with_member
from millrun.functions.timefn import date_text, epoch_ms_to_ts
from millrun.operators import dims, inspect, parse, parts, rollup, routing, stats
from millrun.plans.jobs import e2_apply_dims, e2_change_records
from millrun.streaming import io
from millrun.streaming.ordered import enrich_asof_stream
from millrun.streaming.stateful import new_part_flag_stream, unique_part_stream

# Trigger intervals of the jobs' checkpoint settings (E1 5 s, E2/E4 60 s,
# E5 6 s); out-of-order bounds 2 s (E4) and 3 s (E5); join bound 5 s.
TRIGGERS = {"e1": "5 seconds", "e2": "60 seconds", "e3": "5 seconds", "e4": "60 seconds", "e5": "6 seconds"}

E1_OUTPUTS = ("machine_start", "weld_start", "shutdown", "heartbeat", "manufacture",
              "manufacture_detail", "large_part_progress")


# -------------------------------------------------------------------- E1


def e1_stream(text: DataFrame) -> DataFrame:
    """Parse, correct the new-part flag per part (stateful), add ``route``.
    Dead-letter rows join the output behind the keyed step with their
    ``dead_reason``: they have no key, and would be one group."""
    p = _ordered(parse.parse_equipment_logs(text))
    flat = p.select(
        "seq",
        "raw",
        "part_id",
        "is_new",
        F.col("is_new").alias("given_new"),
        date_text(F.col("log_date")).alias("log_day"),
        F.col("common.ts").alias("ts_text"),
        F.when(F.size("start") > 0, F.col("start").getItem("type")).alias("start_type"),
        "log_type",
        "dead_reason",
    )
    flagged = new_part_flag_stream(flat.filter("dead_reason is null"), "part_id", "is_new", "log_day", "seq", "dead_reason")
    flagged = flagged.unionByName(flat.filter("dead_reason is not null"))
    # the whole record goes on; only a corrected flag changes it
    kept = F.col("given_new").eqNullSafe(F.col("is_new"))
    fixed = F.when(kept, F.col("raw")).otherwise(with_member("raw", "common", "is_new", F.col("is_new")))
    value = F.when(F.col("dead_reason").isNull(), fixed)
    routed = flagged.withColumn("route", routing.route_of(F.col("start_type"), F.col("log_type")))
    return routed.withColumn("value", value).drop("given_new")


def _ordered(parsed: DataFrame) -> DataFrame:
    """A record without an order of arrival is a dead letter: the keyed steps depend on it."""
    reason = F.coalesce("dead_reason", F.when(F.col("seq").isNull(), F.lit("no_seq")))
    return parsed.withColumn("dead_reason", reason)


def start_e1(text: DataFrame, out_root: str, name: str = "e1_equipment_logs", trigger=None, checkpoint=None,
             bootstrap: str | None = None):
    outputs = {"main": (F.col("dead_reason").isNull(), f"{out_root}/dwd_equipment_log", "json"),
               "dead_letter": (F.col("dead_reason").isNotNull(), f"{out_root}/dead_letter", "json")}
    for r in E1_OUTPUTS:
        outputs[r] = (F.col("route") == r, f"{out_root}/dwd_{r}_log", "json")
    q = e1_stream(text).writeStream.foreachBatch(io.fan_out(outputs, bootstrap))
    return _start(q, text.sparkSession, name, trigger or {"processingTime": TRIGGERS["e1"]}, checkpoint)


# -------------------------------------------------------------------- E2


def e2_batch_writer(
    spark: SparkSession,
    rules_loader: Callable[[], DataFrame],
    out_root: str,
    dim_root: str,
    bootstrap: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: rules are re-read for every micro-batch (a
    removed rule stops applying), facts go to the topic named by their rule
    (message queue when ``bootstrap`` is given, else one folder per topic),
    dim rows are merged into their tables under (query id, batch id), the
    rest is dead-lettered."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rules = rules_loader()
        batch.persist()
        try:
            out = e2_change_records(batch, rules)
            if bootstrap:
                (out["facts"].select("topic", "value").write.format("kafka")
                 .option("kafka.bootstrap.servers", bootstrap).save())
            else:
                out["facts"].write.mode("overwrite").partitionBy("topic").json(
                    f"{out_root}/facts/batch={batch_id}")
            out["dead_letter"].write.mode("overwrite").json(f"{out_root}/dead_letter/batch={batch_id}")
            if "malformed" in out:
                out["malformed"].write.mode("overwrite").json(f"{out_root}/malformed/batch={batch_id}")
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
            e2_apply_dims(spark, out["dim_changes"], rules, dim_root, batch_id, run=run)
        finally:
            batch.unpersist()

    return run


def start_e2(text: DataFrame, rules_loader, out_root: str, dim_root: str, name: str = "e2_change_records",
             trigger=None, checkpoint=None, bootstrap: str | None = None):
    spark = text.sparkSession
    cdc = parse.parse_change_records(text)
    q = cdc.writeStream.foreachBatch(e2_batch_writer(spark, rules_loader, out_root, dim_root, bootstrap))
    return _start(q, spark, name, trigger or {"processingTime": TRIGGERS["e2"]}, checkpoint)


# -------------------------------------------------------------------- E3


def e3_stream(text: DataFrame, ttl_ms: int = 24 * 3600 * 1000, cleanup: bool = True) -> DataFrame:
    p = _ordered(parse.parse_manufacture_logs(text))
    flat = p.select(
        "seq",
        "raw",
        "part_id",
        "ts",
        date_text(F.col("mdate")).alias("mday"),
        "dead_reason",
    )
    unique = unique_part_stream(flat.filter("dead_reason is null"), "part_id", "mday", "seq", ttl_ms, "dead_reason", cleanup)
    unique = unique.unionByName(flat.filter("dead_reason is not null"))
    return unique.withColumn("value", F.when(F.col("dead_reason").isNull(), F.col("raw")))


def start_e3(text: DataFrame, out_root: str, name: str = "e3_unique_part", trigger=None, checkpoint=None,
             cleanup: bool = True, bootstrap: str | None = None):
    outputs = {"unique": (F.col("dead_reason").isNull(), f"{out_root}/dwm_unique_part", "json"),
               "dead_letter": (F.col("dead_reason").isNotNull(), f"{out_root}/dead_letter", "json")}
    q = e3_stream(text, cleanup=cleanup).writeStream.foreachBatch(io.fan_out(outputs, bootstrap))
    return _start(q, text.sparkSession, name, trigger or {"processingTime": TRIGGERS["e3"]}, checkpoint)


# -------------------------------------------------------------------- E4


def e4_stream(
    info: DataFrame,
    detail: DataFrame,
    equipment: DataFrame | None = None,
    lower_ms: int = -5000,
    upper_ms: int = 5000,
    delay: str = "2 seconds",
) -> DataFrame:
    """Stream-stream interval join of parsed info/detail records (orderId,
    ts ms, ...), both sides watermarked; state older than the bound plus
    the delay is evicted. Optional stream-static equipment lookup."""
    i = info.select(*[F.col(c).alias(f"info_{c}") for c in info.columns]).withColumn(
        "info_time", epoch_ms_to_ts("info_ts")).withWatermark("info_time", delay)
    d = detail.select(*[F.col(c).alias(f"detail_{c}") for c in detail.columns]).withColumn(
        "detail_time", epoch_ms_to_ts("detail_ts")).withWatermark("detail_time", delay)
    wide = inspect.interval_join(i, d, "info_orderId", "info_time", "detail_time", lower_ms, upper_ms,
                                 right_key="detail_orderId")
    if equipment is not None and "detail_equipmentId" in wide.columns:
        wide = dims.enrich(wide, equipment, "detail_equipmentId", "id", {"start_date": "equipment_start"})
    return wide


def start_e4(wide: DataFrame, out_path: str, name: str = "e4_inspect_wide", trigger=None, checkpoint=None,
             bootstrap: str | None = None):
    """Append the joined rows to a file sink (exactly once) or to the queue."""
    if bootstrap:
        return io.kafka_sink(io.messages(wide), name, bootstrap, out_path.rstrip("/").rsplit("/", 1)[-1], checkpoint,
                             trigger or {"processingTime": TRIGGERS["e4"]})
    w = wide.writeStream.format("json").outputMode("append").option("path", out_path)
    return _start(w, wide.sparkSession, name, trigger or {"processingTime": TRIGGERS["e4"]}, checkpoint)


def start_e4_fresh_dims(
    wide: DataFrame,
    equipment_loader: Callable[[], DataFrame],
    out_path: str,
    name: str = "e4_inspect_wide_fresh",
    trigger=None,
    checkpoint=None,
    bootstrap: str | None = None,
):
    """E4 with the equipment dim (id, start_date) re-read for every
    micro-batch: joined rows get the equipment's start date and working
    days at event time, written to ``batch=<id>`` (replays replace
    themselves)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        out = dims.enrich(batch, equipment_loader(), "detail_equipmentId", "id", {"start_date": "equipment_start"})
        out = out.withColumn(
            "working_days", F.datediff(F.to_date("detail_time"), F.col("equipment_start")).cast("bigint")
        )
        io.deliver(out, out_path, "json", batch_id, bootstrap)

    q = wide.writeStream.outputMode("append").foreachBatch(run)
    return _start(q, wide.sparkSession, name, trigger or {"processingTime": TRIGGERS["e4"]}, checkpoint)


def e4_equipment_asof_stream(
    detail: DataFrame, equipment_changes: DataFrame, delay: str = "2 seconds", dim_delay: str | None = None, salts: int = 1
) -> DataFrame:
    """Parsed details (orderId, equipmentId, ts ms, ...) with the equipment's
    start date as it stood at the detail's time, and the working days since.
    ``equipment_changes`` is the dim's change stream (id, start_date, ts ms,
    seq); a record without an id is a tick."""
    facts = detail.withColumn("detail_time", epoch_ms_to_ts("ts"))
    versions = equipment_changes.select(
        "id", F.col("start_date").cast("date").alias("equipment_start"), epoch_ms_to_ts("ts").alias("dim_time"), F.col("seq").alias("dim_seq")
    )
    out = enrich_asof_stream(facts, versions, "equipmentId", "detail_time", "id", "dim_time", "dim_seq", ["equipment_start"], delay, dim_delay, salts)
    return out.withColumn("working_days", F.datediff(F.to_date("detail_time"), F.col("equipment_start")).cast("bigint"))


# -------------------------------------------------------------------- E5


def e5_stream(
    detail: DataFrame,
    per_size: DataFrame,
    recheck: DataFrame,
    production: DataFrame,
    window: str = "10 seconds",
    delay: str = "3 seconds",
    per_feed: bool = False,
) -> DataFrame:
    """Three feeds (mid, isNew, isPass, ts ms) -> watermarks -> union ->
    production dim (stream-static, broadcast when small) -> window sums."""
    feeds = _e5_feeds(detail, per_size, recheck, delay, per_feed)
    lookup = [(production, "mid", "id", {"Fid": "fid", "lid": "lid", "mType": "mtype", "eId": "eid"})]
    return stats.size_stats_enriched(feeds, lookup, "ts", window, grain=("mid", "isnew"), preaggregate=False)


def _e5_feeds(detail: DataFrame, per_size: DataFrame, recheck: DataFrame, delay: str, per_feed: bool) -> DataFrame:
    """The union of the three feeds, watermarked. ``per_feed``: each feed has a
    watermark of its own and the least of them holds
    (``spark.sql.streaming.multipleWatermarkPolicy``), so a feed that lags
    loses no rows to a faster one; one that may fall silent holds every window
    open until it speaks again. Else one watermark follows the fastest feed."""
    keep = [F.col("mid"), F.col("isNew").alias("isnew"), epoch_ms_to_ts("ts").alias("ts")]
    feeds = [stats.normalise(f, name, keep) for f, name in ((detail, "detail"), (per_size, "per_size"), (recheck, "recheck"))]
    if per_feed:
        return stats.union_feeds(*[f.withWatermark("ts", delay) for f in feeds])
    return stats.union_feeds(*feeds).withWatermark("ts", delay)


def e5_grain_stream(
    detail: DataFrame,
    per_size: DataFrame,
    recheck: DataFrame,
    window: str = "10 seconds",
    delay: str = "3 seconds",
    per_feed: bool = False,
) -> DataFrame:
    """Three feeds -> watermarks -> union -> window sums per (production id,
    new flag), append mode. Every row of a window leaves in the same
    micro-batch (the one whose watermark passes the window's end), so a
    per-batch roll-up to the dim keys is complete (``start_e5_fresh_dims``)."""
    feeds = _e5_feeds(detail, per_size, recheck, delay, per_feed)
    sums = feeds.groupBy(F.window("ts", window).alias("_w"), "mid", "isnew").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in stats.MEASURES]
    )
    return sums.select(F.col("_w.start").alias("ts"), "mid", "isnew", *stats.MEASURES)


def e5_rollup_stream(
    detail: DataFrame,
    per_size: DataFrame,
    recheck: DataFrame,
    production: DataFrame,
    periods: Sequence[str] = ("10 seconds", "1 hour", "1 day"),
    delay: str = "3 seconds",
    per_feed: bool = False,
) -> DataFrame:
    """Window sums rolled up along ``periods`` in one stream: each period's
    closed windows are the next one's rows; the last period leaves at every
    level of the hierarchy, once its window is closed."""
    feeds = _e5_feeds(detail, per_size, recheck, delay, per_feed)
    lookup = [(production, "mid", "id", {"Fid": "fid", "lid": "lid", "mType": "mtype", "eId": "eid"})]
    return rollup.by_level(rollup.chained_sums(feeds, lookup, "ts", periods, grain=("mid",))[-1], periods[-1])


def start_e5_fresh_dims(
    grain: DataFrame,
    production_loader: Callable[[], DataFrame],
    out_path: str,
    window: str = "10 seconds",
    name: str = "e5_size_stats_fresh",
    trigger=None,
    checkpoint=None,
    bootstrap: str | None = None,
):
    """E5 with the production dim re-read for every micro-batch (no stale
    lookup): enrich the closed windows' partial sums, roll up to
    (window, factory, line, process type, equipment, flag), write
    ``batch=<id>`` (overwrite: replays replace themselves)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        lookup = [(production_loader(), "mid", "id", {"Fid": "fid", "lid": "lid", "mType": "mtype", "eId": "eid"})]
        out = stats.size_stats_enriched(batch, lookup, "ts", window, grain=("mid", "isnew"), preaggregate=False)
        io.deliver(out, out_path, "json", batch_id, bootstrap)

    q = grain.writeStream.outputMode("append").foreachBatch(run)
    return _start(q, grain.sparkSession, name, trigger or {"processingTime": TRIGGERS["e5"]}, checkpoint)


def start_e5(stream: DataFrame, out_path: str, name: str = "e5_size_stats", trigger=None, checkpoint=None):
    w = stream.writeStream.format("json").outputMode("append").option("path", out_path)
    return _start(w, stream.sparkSession, name, trigger or {"processingTime": TRIGGERS["e5"]}, checkpoint)


def start_part_sketches(parsed: DataFrame, path: str, part: str = "part_id", day: str = "mdate", name: str = "part_sketches", trigger=None, checkpoint=None):
    """Daily sketches of the parts of each micro-batch, as ``<path>/batch=<id>``
    (a replay replaces its own). They are never read back to be changed:
    ``parts.merge_sketches`` of the folder is the count so far."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parts.daily_part_sketches(batch, part, day).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = parsed.writeStream.foreachBatch(run)
    return _start(q, parsed.sparkSession, name, trigger or {"processingTime": TRIGGERS["e3"]}, checkpoint)


def start_dead_letters(parsed: list[DataFrame], out_root: str, name: str, trigger=None, checkpoint=None,
                       bootstrap: str | None = None):
    """What of ``parsed`` could not be read, with its reason (E4 and E5)."""
    dead = [parse.dead(p).select("raw", "dead_reason") for p in parsed]
    rows = dead[0]
    for d in dead[1:]:
        rows = rows.unionByName(d)
    outputs = {"dead_letter": (None, f"{out_root}/dead_letter", "json")}
    q = rows.writeStream.foreachBatch(io.fan_out(outputs, bootstrap))
    return _start(q, rows.sparkSession, name, trigger or {"processingTime": TRIGGERS["e4"]}, checkpoint)


def _start(writer, spark: SparkSession, name: str, trigger: Mapping[str, object], checkpoint: str | None):
    return (
        writer.queryName(name)
        .option("checkpointLocation", io.checkpoint_for(spark, name, checkpoint))
        .trigger(**trigger)
        .start()
    )
