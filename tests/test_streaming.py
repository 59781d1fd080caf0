"""Batch = stream: the streaming forms give the batch answer for in-order
input, whether the rows arrive in one micro-batch or several; and a
restart from the checkpoint neither loses nor repeats rows."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrun.plans import jobs as bjobs
from millrun.streaming import jobs as sjobs
from millrun.streaming.io import file_text_source

DAY = 86_400_000


def _write_batches(root: str, batches: list[list[str]]) -> None:
    os.makedirs(root, exist_ok=True)
    for i, lines in enumerate(batches):
        with open(os.path.join(root, f"part-{i:04d}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")


def _run_to_memory(df, name: str, ckpt: str, mode: str = "append"):
    """Run until every available row is processed, then stop. (A query
    with processing-time state timeouts always wants another batch, so it
    is driven with ``processAllAvailable`` rather than ``availableNow``.)"""
    q = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", ckpt)
        .trigger(processingTime="200 milliseconds")
        .start()
    )
    q.processAllAvailable()
    q.stop()
    return q


def _equipment_lines():
    # (part, is_new, ts text, start type) in arrival order, FIXTURES A1.
    recs = [
        ("p1", "1", "2024-01-01 08:00:00", "MachineTool_Start"),
        ("p1", 1, "2024-01-01 09:00:00", None),          # same day: stays 1
        ("p1", "1", "2024-01-02 08:00:00", "WeldRobotStart"),  # later day: 0
        ("p1", "1", "2023-12-31 08:00:00", "WeldRobot_Start"),  # earlier day: 0
        ("p2", "0", "2024-01-01 08:00:00", "other"),     # 0 does not set the day
        ("p2", "1", "2024-01-02 08:00:00", None),        # first new: stays 1
        ("p2", "1", "2024-01-02 10:00:00", None),
        ("p3", "1", "1704096000000", None),              # epoch-ms text
    ]
    lines = []
    for seq, (p, n, ts, st) in enumerate(recs):
        rec = {"common": {"part_id": p, "is_new": n, "ts": ts}, "seq": seq}
        if st is not None:
            rec["start"] = {"type": st}
        lines.append(json.dumps(rec))
    lines.append("{not json")
    lines.append(json.dumps({"seq": 99, "start": {}}))  # no common
    return lines


@pytest.mark.parametrize("splits", [1, 3])
def test_e1_stream_equals_batch(spark, tmp_dir, splits):
    lines = _equipment_lines()
    step = -(-len(lines) // splits)
    src = f"{tmp_dir}/src"
    _write_batches(src, [lines[i : i + step] for i in range(0, len(lines), step)])

    text = file_text_source(spark, src, max_files_per_trigger=1)
    name = f"e1_{splits}"
    q = _run_to_memory(sjobs.e1_stream(text), name, f"{tmp_dir}/ckpt")
    streamed = spark.table(name)
    got = rows(streamed.filter("dead_reason IS NULL"), "seq", "is_new", "route")

    batch = bjobs.e1_equipment_logs(spark.read.text(src))
    want = rows(batch["main"], "seq", "is_new", "route")
    assert got == want
    flags = {s: n for s, n, _ in got}
    assert [flags[i] for i in range(8)] == ["1", "1", "0", "0", "0", "1", "1", "1"]
    routes = {s: r for s, _, r in got}
    assert routes[0] == "machine_start" and routes[2] == "weld_start" and routes[3] == "weld_start"
    assert routes[4] is None
    assert streamed.filter("dead_reason IS NOT NULL").count() == 2
    assert batch["dead_letter"].count() == 2


def _manufacture_lines():
    # FIXTURES A2: d1, d2, d1 passes three times in change mode.
    base = 1_704_067_200_000  # 2024-01-01T00:00Z
    recs = [
        ("a", base), ("a", base + 1000), ("a", base + DAY), ("a", base + 2 * 1000),
        ("b", base + DAY - 1), ("b", base + DAY),  # 23:59:59.999 then 00:00
        ("c", base), ("d", base),
    ]
    return [json.dumps({"common": {"partId": p}, "ts": t, "seq": i}) for i, (p, t) in enumerate(recs)]


@pytest.mark.parametrize("splits", [1, 4])
def test_e3_stream_equals_batch(spark, tmp_dir, splits):
    lines = _manufacture_lines()
    step = -(-len(lines) // splits)
    src = f"{tmp_dir}/src"
    _write_batches(src, [lines[i : i + step] for i in range(0, len(lines), step)])
    name = f"e3_{splits}"
    q = _run_to_memory(sjobs.e3_stream(file_text_source(spark, src, 1), cleanup=False), name, f"{tmp_dir}/ckpt")
    got = rows(spark.table(name).filter("dead_reason IS NULL"), "seq")
    batch = bjobs.e3_unique_parts(spark.read.text(src))["unique_part"]
    assert got == rows(batch, "seq")
    assert [s for (s,) in got] == [0, 2, 3, 4, 5, 6, 7]
    q.stop()


def test_e3_restart_no_loss_no_duplicates(spark, tmp_dir):
    lines = _manufacture_lines()
    src = f"{tmp_dir}/src"
    _write_batches(src, [lines[:4]])
    out = f"{tmp_dir}/out"
    ckpt = f"{tmp_dir}/ckpt"
    q = sjobs.start_e3(file_text_source(spark, src), out, name="e3_restart_a",
                       trigger={"processingTime": "200 milliseconds"}, checkpoint=ckpt, cleanup=False)
    q.processAllAvailable()
    q.stop()
    with open(f"{src}/part-0001.json", "w") as f:
        f.write("\n".join(lines[4:]) + "\n")
    q = sjobs.start_e3(file_text_source(spark, src), out, name="e3_restart_b",
                       trigger={"processingTime": "200 milliseconds"}, checkpoint=ckpt, cleanup=False)
    q.processAllAvailable()
    q.stop()
    got = spark.read.json(f"{out}/dwm_unique_part/*").select("seq").collect()
    assert sorted(r.seq for r in got) == [0, 2, 3, 4, 5, 6, 7]


def test_e4_stream_interval_join(spark, tmp_dir):
    base = 1_704_067_200_000
    info = [{"orderId": "o1", "ts": base}, {"orderId": "o2", "ts": base}, {"orderId": None, "ts": base}]
    det = [
        {"orderId": "o1", "ts": base - 5000}, {"orderId": "o1", "ts": base},
        {"orderId": "o1", "ts": base + 5000}, {"orderId": "o1", "ts": base - 5001},
        {"orderId": "o1", "ts": base + 5001}, {"orderId": "o3", "ts": base},
        {"orderId": None, "ts": base},
    ]
    schema = "orderId string, ts long"
    _write_batches(f"{tmp_dir}/i", [[json.dumps(r) for r in info]])
    _write_batches(f"{tmp_dir}/d", [[json.dumps(r) for r in det]])
    i = spark.readStream.schema(schema).json(f"{tmp_dir}/i")
    d = spark.readStream.schema(schema).json(f"{tmp_dir}/d")
    q = _run_to_memory(sjobs.e4_stream(i, d), "e4s", f"{tmp_dir}/ckpt")
    got = rows(spark.table("e4s"), "info_orderId", "detail_ts")
    want = rows(bjobs.e4_inspection_wide(spark.read.schema(schema).json(f"{tmp_dir}/i"),
                                         spark.read.schema(schema).json(f"{tmp_dir}/d")),
                "info_orderId", "detail_ts")
    assert got == want == [("o1", base - 5000), ("o1", base), ("o1", base + 5000)]
    q.stop()


def test_e5_stream_window_sums(spark, tmp_dir):
    base = 1_704_067_200_000
    det = [{"mid": "m1", "isNew": "1", "isPass": p, "ts": base + t} for p, t in
           [("1", 0), ("0", 1000), (None, 9999), ("1", 10_000)]]
    det.append({"mid": "m9", "isNew": "0", "isPass": "1", "ts": base + 60_000})  # closes windows
    size = [{"mid": "m1", "isNew": "1", "isPass": "0", "ts": base + 2000}]
    rec = [{"mid": "m1", "isNew": "1", "isPass": "0", "ts": base + 3000}]
    schema = "mid string, isNew string, isPass string, ts long"
    for n, recs in (("d", det), ("s", size), ("r", rec)):
        _write_batches(f"{tmp_dir}/{n}", [[json.dumps(r) for r in recs]])
    prod = spark.createDataFrame([("m1", "e1", "f1", "t1", "l1")], "id string, eId string, Fid string, mType string, lid string")
    streams = [spark.readStream.schema(schema).json(f"{tmp_dir}/{n}") for n in "dsr"]
    out = sjobs.e5_stream(*streams, prod, window="10 seconds", delay="3 seconds")
    q = _run_to_memory(out, "e5s", f"{tmp_dir}/ckpt")
    got = {r.wbt: r for r in spark.table("e5s").filter("eid = 'e1'").collect()}
    w0 = got["2024-01-01 00:00:00"]
    assert (w0.defect_sum, w0.check_sum, w0.defect_type_count, w0.double_sum, w0.double_fail_sum) == (2, 3, 1, 1, 1)
    assert (w0.fid, w0.lid, w0.mtype, w0.eid, w0.isnew) == ("f1", "l1", "t1", "e1", "1")
    batch = bjobs.e5_size_stats(*[spark.read.schema(schema).json(f"{tmp_dir}/{n}") for n in "dsr"], prod)
    b0 = batch.filter("wbt = '2024-01-01 00:00:00' AND eid = 'e1'").first()
    assert b0.defect_sum == 2 and b0.check_sum == 3
    q.stop()


def test_e3_stream_with_state_cleanup(spark, tmp_dir):
    """Processing-time cleanup mode: same rows; the query keeps planning
    cleanup batches, so wait for the data batch instead of catch-up."""
    import time

    src = f"{tmp_dir}/src"
    _write_batches(src, [_manufacture_lines()])
    q = (sjobs.e3_stream(file_text_source(spark, src), cleanup=True)
         .writeStream.format("memory").queryName("e3_cleanup")
         .option("checkpointLocation", f"{tmp_dir}/ckpt")
         .trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 120
    while time.time() < deadline:
        done = [p for p in q.recentProgress if p["numInputRows"] > 0]
        if done and q.lastProgress["batchId"] > done[-1]["batchId"]:
            break
        time.sleep(0.5)
    q.stop()
    got = sorted(r.seq for r in spark.table("e3_cleanup").filter("dead_reason IS NULL").collect())
    assert got == [0, 2, 3, 4, 5, 6, 7]


def test_e2_stream_routes_and_upserts(spark, tmp_dir):
    """Change records through foreachBatch: facts per topic, dim snapshot
    per batch id, dead letters; rules re-read per batch."""
    from millrun.operators import dims
    from millrun.sources.shapes import RULE

    def cdc(seq, table, op, data):
        return json.dumps({"table": table, "type": op, "ts": seq, "seq": seq, "data": data})

    batches = [
        [cdc(1, "users", "insert", {"id": "u1", "name": "a", "extra": "x"}),
         cdc(2, "orders", "insert", {"id": "o1", "amount": 5}),
         cdc(3, "users", "insert", {"id": "u2", "name": "b"}),
         cdc(4, "users", "insert", {}),
         "{broken"],
        [cdc(5, "users", "update", {"id": "u1", "name": "a2"}),
         cdc(6, "users", "delete", {"id": "u2"}),
         cdc(7, "shops", "insert", {"id": "s1"})],
    ]
    src = f"{tmp_dir}/src"
    _write_batches(src, batches)
    rules_rows = [
        ("users", "insert", "hbase", "dim_users", "id,name", "", None, 1),
        ("users", "update", "HBASE", "dim_users", "id,name", None, None, 1),
        ("users", "delete", "hbase", "dim_users", "id,name", None, None, 1),
        ("orders", "insert", "kafka", "dwd_orders", "id,amount", None, None, 1),
    ]
    rules_loader = lambda: spark.createDataFrame(rules_rows, RULE)
    q = sjobs.start_e2(file_text_source(spark, src, 1), rules_loader, f"{tmp_dir}/out", f"{tmp_dir}/dim",
                       trigger={"processingTime": "200 milliseconds"}, checkpoint=f"{tmp_dir}/ckpt")
    q.processAllAvailable()
    q.stop()
    snap = dims.read_snapshot(spark, f"{tmp_dir}/dim", "dim_users")
    assert rows(snap, "id", "name") == [("u1", "a2")]
    facts = spark.read.json(f"{tmp_dir}/out/facts")
    assert [(r.topic, json.loads(r.value)) for r in facts.collect()] == [("dwd_orders", {"id": "o1", "amount": "5"})]
    dead = spark.read.json(f"{tmp_dir}/out/dead_letter/*")
    assert sorted(r.seq for r in dead.collect()) == [7]
    bad = spark.read.json(f"{tmp_dir}/out/malformed/*").collect()
    assert [(r.raw, r.dead_reason) for r in bad] == [("{broken", "malformed_json")]


def test_e2_rule_change_between_batches(spark, tmp_dir):
    """Rules are re-read per micro-batch: a rule added after batch 0
    routes batch 1; removing it would stop it (O-R4)."""
    from millrun.sources.shapes import RULE

    def cdc(seq, table):
        return json.dumps({"table": table, "type": "insert", "ts": seq, "seq": seq, "data": {"id": str(seq)}})

    src = f"{tmp_dir}/src"
    _write_batches(src, [[cdc(1, "orders")]])
    rules = [[("orders", "insert", "kafka", "dwd_a", "id", None, None, 1)]]
    q = sjobs.start_e2(file_text_source(spark, src, 1), lambda: spark.createDataFrame(rules[0], RULE),
                       f"{tmp_dir}/out", f"{tmp_dir}/dim", trigger={"processingTime": "200 milliseconds"},
                       checkpoint=f"{tmp_dir}/ckpt")
    q.processAllAvailable()
    rules[0] = [("orders", "insert", "kafka", "dwd_b", "id", None, None, 1)]
    with open(f"{src}/part-0001.json", "w") as f:
        f.write(cdc(2, "orders") + "\n")
    q.processAllAvailable()
    q.stop()
    facts = spark.read.json(f"{tmp_dir}/out/facts")
    got = sorted((r.topic, json.loads(r.value)["id"]) for r in facts.collect())
    assert got == [("dwd_a", "1"), ("dwd_b", "2")]


def test_other_stream_forms(spark, tmp_dir):
    """Re-check feed (stateful), distinct unique-part (built-in dedupe
    within the watermark) and up-time sessions (session window) on streams
    agree with their batch forms."""
    from millrun.operators import inspect, stats
    from millrun.streaming.stateful import recheck_stream, unique_part_distinct_stream

    base = 1_704_067_200_000
    det = [{"mid": m, "size_id": s, "seq": i, "ts": base + i * 1000}
           for i, (m, s) in enumerate([("m1", "a"), ("m1", "a"), ("m1", "b"), ("m1", "a"), ("m2", "a")])]
    _write_batches(f"{tmp_dir}/det", [[json.dumps(r) for r in det[:2]], [json.dumps(r) for r in det[2:]]])
    schema = "mid string, size_id string, seq long, ts long"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/det")
    _run_to_memory(recheck_stream(s, ["mid", "size_id"], "seq"), "re_s", f"{tmp_dir}/ck1")
    batch = inspect.recheck_rows(spark.read.schema(schema).json(f"{tmp_dir}/det"), order=["seq"])
    assert rows(spark.table("re_s"), "seq") == rows(batch, "seq") == [(1,), (3,)]

    day = 86_400_000
    logs = [{"part_id": p, "ts": base + t} for p, t in
            [("a", 0), ("a", 1000), ("a", day), ("b", 0), ("a", day + 5)]]
    _write_batches(f"{tmp_dir}/m", [[json.dumps(r) for r in logs]])
    m = spark.readStream.schema("part_id string, ts long").json(f"{tmp_dir}/m").withColumn(
        "mts", F.timestamp_millis("ts"))
    _run_to_memory(unique_part_distinct_stream(m, "part_id", "mts", "2 days"), "uniq_s", f"{tmp_dir}/ck2")
    assert sorted((r.part_id, r.ts - base) for r in spark.table("uniq_s").collect()) == [
        ("a", 0), ("a", day), ("b", 0)]

    minute = 60_000
    beats = [{"eq": "e", "ts": base + k * minute} for k in (0, 3, 9, 20, 23)] + [{"eq": "e", "ts": base + 600 * minute}]
    _write_batches(f"{tmp_dir}/b", [[json.dumps(r) for r in beats]])
    b = spark.readStream.schema("eq string, ts long").json(f"{tmp_dir}/b").withColumn(
        "t", F.timestamp_millis("ts")).withWatermark("t", "1 minute")
    _run_to_memory(stats.uptime_sessions_stream(b, "eq", "t", "6 minutes"), "up_s", f"{tmp_dir}/ck3")
    got = rows(spark.table("up_s"), "first_beat", "n_beats")
    bstatic = spark.read.schema("eq string, ts long").json(f"{tmp_dir}/b").withColumn("t", F.timestamp_millis("ts"))
    want = rows(stats.uptime_sessions(bstatic, "eq", "t"), "first_beat", "n_beats")
    assert got == want[:2]  # the last session is still open behind the watermark


def test_daily_part_count_stream(spark, tmp_dir):
    from millrun.streaming.io import late_rows_dropped
    from millrun.streaming.stateful import daily_part_count_stream

    base, day = 1_704_067_200_000, 86_400_000
    recs = [("a", 0), ("a", 5), ("b", 9), ("a", day), ("c", day + 1), ("z", 5 * day)]
    _write_batches(f"{tmp_dir}/m", [[json.dumps({"part_id": p, "ts": base + t}) for p, t in recs]])
    m = spark.readStream.schema("part_id string, ts long").json(f"{tmp_dir}/m").withColumn(
        "mts", F.timestamp_millis("ts"))
    q = _run_to_memory(daily_part_count_stream(m, "part_id", "mts", "1 day"), "daily_s", f"{tmp_dir}/ck")
    got = sorted((str(r.mdate), r.n_parts) for r in spark.table("daily_s").collect())
    assert got == [("2024-01-01", 2), ("2024-01-02", 2)]
    assert late_rows_dropped(q) == 0


def test_e4_file_sink_exactly_once(spark, tmp_dir):
    base = 1_704_067_200_000
    schema = "orderId string, ts long"
    _write_batches(f"{tmp_dir}/i", [[json.dumps({"orderId": "o1", "ts": base})]])
    _write_batches(f"{tmp_dir}/d", [[json.dumps({"orderId": "o1", "ts": base + 1000})]])
    wide = sjobs.e4_stream(spark.readStream.schema(schema).json(f"{tmp_dir}/i"),
                           spark.readStream.schema(schema).json(f"{tmp_dir}/d"))
    for _ in range(2):  # a restart on the same checkpoint adds nothing
        q = sjobs.start_e4(wide, f"{tmp_dir}/out", trigger={"processingTime": "200 milliseconds"},
                           checkpoint=f"{tmp_dir}/ck")
        q.processAllAvailable()
        q.stop()
    got = spark.read.json(f"{tmp_dir}/out").collect()
    assert [(r.info_orderId, r.detail_ts) for r in got] == [("o1", base + 1000)]


def test_e5_fresh_dims_per_batch(spark, tmp_dir):
    """Closed windows are rolled up with the dim snapshot current at that
    batch: a dim change between batches shows in later windows."""
    base = 1_704_067_200_000
    schema = "mid string, isNew string, isPass string, ts long"
    src = f"{tmp_dir}/d"
    _write_batches(src, [[json.dumps({"mid": "m1", "isNew": "1", "isPass": "0", "ts": base}),
                          json.dumps({"mid": "m1", "isNew": "1", "isPass": "1", "ts": base + 20_000})]])
    for n in ("s", "r"):
        _write_batches(f"{tmp_dir}/{n}", [[json.dumps({"mid": "m1", "isNew": "1", "isPass": "0", "ts": base + 1000})]])
    dim_rows = [("m1", "e1", "f1", "t1", "l1")]
    loader = lambda: spark.createDataFrame(dim_rows, "id string, eId string, Fid string, mType string, lid string")
    streams = [spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/{n}") for n in "dsr"]
    grain = sjobs.e5_grain_stream(*streams, window="10 seconds", delay="3 seconds")
    q = sjobs.start_e5_fresh_dims(grain, loader, f"{tmp_dir}/out", "10 seconds",
                                  trigger={"processingTime": "200 milliseconds"}, checkpoint=f"{tmp_dir}/ck")
    q.processAllAvailable()
    dim_rows[0] = ("m1", "e2", "f2", "t2", "l2")  # the dim changes
    with open(f"{src}/part-0001.json", "w") as f:
        f.write(json.dumps({"mid": "m1", "isNew": "1", "isPass": "1", "ts": base + 60_000}) + "\n")
    q.processAllAvailable()
    q.stop()
    got = {(r.wbt, r.fid): (r.defect_sum, r.check_sum, r.defect_type_count, r.double_sum, r.double_fail_sum)
           for r in spark.read.json(f"{tmp_dir}/out").collect()}
    assert got[("2024-01-01 00:00:00", "f1")] == (1, 1, 1, 1, 1)
    assert got[("2024-01-01 00:00:20", "f2")] == (0, 1, 0, 0, 0)


def test_first_defect_stream_matches_batch(spark, tmp_dir):
    from millrun.operators import inspect
    from millrun.streaming.stateful import first_defect_stream

    base, day = 1_704_067_200_000, 86_400_000
    recs = [("m1", "a", "0", 0), ("m1", "a", "0", 1000), ("m1", "a", "1", 2000), ("m1", "b", None, 3000),
            ("m1", "a", "0", day + 5), ("m2", "a", "1", 10)]
    _write_batches(f"{tmp_dir}/d", [[json.dumps({"mid": m, "size_id": s, "isPass": p, "ts": base + t})
                                     for m, s, p, t in recs]])
    schema = "mid string, size_id string, isPass string, ts long"
    s = spark.readStream.schema(schema).json(f"{tmp_dir}/d").withColumn("ets", F.timestamp_millis("ts"))
    _run_to_memory(first_defect_stream(s), "fd_s", f"{tmp_dir}/ck")
    got = rows(spark.table("fd_s"), "mid", "size_id", "ts")
    b = spark.read.schema(schema).json(f"{tmp_dir}/d").withColumn("ets", F.timestamp_millis("ts")) \
        .withColumn("day", F.to_date("ets"))
    want = rows(inspect.first_defect_per_size(b, order=["ts"]), "mid", "size_id", "ts")
    assert got == want == [("m1", "a", base), ("m1", "a", base + day + 5), ("m1", "b", base + 3000)]


def test_malformed_rows_never_reach_the_state_step(spark, tmp_dir, monkeypatch):
    """A thousand unreadable records and records without an order go round the keyed step."""
    import inspect as py_inspect

    assert "filter(\"dead_reason is null\")" in py_inspect.getsource(sjobs.e1_stream)
    os.makedirs(f"{tmp_dir}/in")
    good = [json.dumps({"common": {"partId": f"p{i % 3}"}, "ts": 1_704_067_200_000, "seq": i}) for i in range(6)]
    lost = [json.dumps({"common": {"partId": "x"}, "ts": 1_704_067_200_000})]
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write("\n".join(good + ["broken{"] * 1000 + lost) + "\n")
    q = _run_to_memory(sjobs.e3_stream(file_text_source(spark, f"{tmp_dir}/in"), cleanup=False), "dead_rows", f"{tmp_dir}/ck")
    out = spark.table("dead_rows")
    assert out.filter("dead_reason = 'malformed_json'").count() == 1000
    assert out.filter("dead_reason = 'no_seq'").count() == 1
    assert out.filter("dead_reason is null").count() == 3
    # the keyed step holds the three parts and nothing else
    assert spark.read.format("statestore").load(f"{tmp_dir}/ck").count() == 3


def test_arrival_orders_across_partitions(spark):
    import datetime as dt

    from millrun.streaming import io as sio

    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    recs = [(t, 1, 7, 0), (t, 1, 10, 1), (t, 2, 1, 2), (t + dt.timedelta(microseconds=1), 0, 0, 3), (t + dt.timedelta(seconds=9), 1, 11, 4)]
    df = spark.createDataFrame(recs, "timestamp timestamp, partition int, offset long, want int").repartition(3)
    got = df.select("want", sio.arrival(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("seq")).orderBy("seq")
    assert [r.want for r in got.collect()] == [0, 1, 2, 3, 4]


def test_outputs_go_to_topics_of_their_names(spark, monkeypatch):
    from millrun.streaming import io as sio

    sent = []

    class Writer:
        def format(self, f):
            self.to = [f]
            return self

        def option(self, k, v):
            self.to.append((k, v))
            return self

        def save(self):
            sent.append(self.to)

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer()))
    df = spark.createDataFrame([("a", "x")], "value string, route string")
    sio.deliver(df, "/out/dwm_unique_part", "json", 3, "broker:9092")
    assert sent == [["kafka", ("kafka.bootstrap.servers", "broker:9092"), ("topic", "dwm_unique_part")]]
    assert sio.messages(df).columns == ["value"]
    assert sio.messages(df.drop("value")).first().value == '{"route":"x"}'


def test_side_tables_by_jdbc_address(spark):
    import pytest as pt

    from millrun.sources.tables import load_side

    with pt.raises(ValueError, match="jdbc"):
        load_side(spark, "jdbc:mysql://host/db")
    with pt.raises(Exception, match="(?i)driver"):  # the address is passed on; no driver here
        load_side(spark, "jdbc:nodb://host/db#table_process")
