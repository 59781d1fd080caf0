"""Hand-made fixtures, one edge per row (FIXTURES.md part A)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from millrun.operators import dims, inspect, keyed, parts, routing, stats
from millrun.sources.shapes import CHANGE_RECORD, RULE

D = dt.date


# ------------------------------------------------------------------ keyed


def test_prev_value_exact_for_any_bucket(spark):
    """The bucketed carry-forward equals a plain lag, however small the
    buckets (one hot key spread over many tasks)."""
    data = [("hot", i, f"d{(i // 3) % 4}") for i in range(60)] + [("cold", i, "x") for i in range(5)]
    df = spark.createDataFrame(data, "k string, seq long, v string")
    want = rows(
        df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("seq"))), "k", "seq", "p"
    )
    for width in (1, 2, 7, 1000):
        got = keyed.prev_value(df, ["k"], ["seq"], "v", "p", F.floor(F.col("seq") / width))
        assert rows(got, "k", "seq", "p") == want


def test_prev_value_skips_nulls_across_buckets(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("a", 3, None), ("a", 9, None), ("a", 10, "y"), ("a", 11, None)],
        "k string, seq long, v string",
    )
    got = keyed.prev_value(df, ["k"], ["seq"], "v", "p", F.floor(F.col("seq") / 2))
    assert rows(got, "seq", "p") == [(1, None), (2, "x"), (3, "x"), (9, "x"), (10, "x"), (11, "y")]


def test_first_last_per_key(spark):
    df = spark.createDataFrame([("a", 3, "c"), ("a", 1, "a"), ("a", 2, "b"), ("b", 5, "z")], "k string, s long, v string")
    assert rows(keyed.first_per_key(df, ["k"], ["s"]), "k", "v") == [("a", "a"), ("b", "z")]
    assert rows(keyed.last_per_key(df, ["k"], ["s"]), "k", "v") == [("a", "c"), ("b", "z")]


def test_bounded_broadcast_falls_back(spark):
    small = spark.range(5)
    big = spark.range(50)
    plan_small = spark.range(100).join(keyed.bounded_broadcast(small, 10), "id")._jdf.queryExecution().executedPlan().toString()
    plan_big = spark.range(100).join(keyed.bounded_broadcast(big, 10), "id")
    assert "BroadcastHashJoin" in plan_small
    assert plan_big.count() == 50


# ------------------------------------------------------------------ parts


def _logs(spark, recs):
    return spark.createDataFrame(recs, "seq long, part_id string, is_new string, log_date date")


def test_new_part_flag_edges(spark):
    recs = [
        (1, "p1", "1", D(2024, 1, 1)),   # first new
        (2, "p1", "1", D(2024, 1, 1)),   # same day again
        (3, "p1", "1", D(2024, 1, 2)),   # later day -> 0
        (4, "p1", "1", D(2023, 12, 31)), # earlier day arriving late -> 0
        (5, "p2", "0", D(2024, 1, 1)),   # old first does not set the day
        (6, "p2", "1", D(2024, 1, 2)),   # -> stays 1
        (7, "p3", "0", D(2024, 1, 1)),   # never new
    ]
    out = parts.new_part_flag(_logs(spark, recs), "part_id", "is_new", "log_date", "seq")
    assert [r[1] for r in rows(out, "seq", "is_new")] == ["1", "1", "0", "0", "0", "1", "0"]


def test_unique_part_modes(spark):
    recs = [(1, "a", D(2024, 1, 1)), (2, "a", D(2024, 1, 1)), (3, "a", D(2024, 1, 2)),
            (4, "a", D(2024, 1, 1)), (5, "b", D(2024, 1, 1)), (6, "c", D(2024, 1, 1))]
    df = spark.createDataFrame(recs, "seq long, part_id string, mdate date")
    change = parts.unique_part_per_day(df, "part_id", "mdate", "seq", mode="change", seq_bucket=2)
    distinct = parts.unique_part_per_day(df, "part_id", "mdate", "seq", mode="distinct")
    assert [r[0] for r in rows(change, "seq")] == [1, 3, 4, 5, 6]
    assert [r[0] for r in rows(distinct, "seq")] == [1, 3, 5, 6]
    counts = parts.daily_part_count(distinct, "part_id", "mdate")
    assert rows(counts, "mdate", "n_parts") == [(D(2024, 1, 1), 3), (D(2024, 1, 2), 1)]
    with pytest.raises(ValueError):
        parts.unique_part_per_day(df, mode="other")


# ---------------------------------------------------------------- routing


def _rules(spark, recs):
    return spark.createDataFrame(recs, RULE)


RULES = [
    ("orders", "insert", "kafka", "dwd_orders", "id,amount", "", None, 1),
    ("orders", "update", "KAFKA", "dwd_orders", "id,amount", None, None, 1),
    ("users", "insert", "hbase", "dim_users", " id , name ", " ", None, 1),
    ("users", "update", "HBASE", "dim_users", "id,name", "id", None, 1),
    ("users", "delete", "hbase", "dim_users", "name", "id", None, 1),      # pk not in columns
    ("items", "insert", "other", "x", "id", None, None, 1),              # unknown sink type
    ("shops", "insert", "kafka", "dwd_shops_old", "id", None, None, 1),
    ("shops", "insert", "kafka", "dwd_shops", "id", None, None, 2),        # later rule wins
]


def _cdc(spark, recs):
    return spark.createDataFrame(recs, CHANGE_RECORD)


def test_validity_filter(spark):
    recs = [
        (None, "insert", 0, 1, {"id": "1"}),
        ("orders", "insert", 0, 2, None),
        ("orders", "insert", 0, 3, {}),
        ("orders", "insert", 0, 4, {"a": None}),
        ("orders", "insert", 0, 5, {"a": "1"}),
    ]
    assert [r[0] for r in rows(routing.valid_changes(_cdc(spark, recs)), "seq")] == [5]


def test_rule_routing(spark):
    recs = [
        ("orders", "insert", 0, 1, {"id": "1", "amount": "5"}),
        ("orders", "UPDATE", 0, 2, {"id": "1"}),            # op key is exact: no rule
        ("users", "insert", 0, 3, {"id": "u1", "name": "o'neil"}),
        ("users", "delete", 0, 4, {"id": "u1"}),
        ("items", "insert", 0, 5, {"id": "i"}),
        ("shops", "insert", 0, 6, {"id": "s"}),
    ]
    routed = routing.route_changes(_cdc(spark, recs), _rules(spark, RULES))
    got = {r.seq: (r.route, r.sink_table, r.reason, r.pk_column) for r in routed.collect()}
    assert got[1][:2] == ("fact", "dwd_orders")
    assert got[2][0] == "dead" and got[2][2] == "no_rule"
    assert got[3] == ("dim", "dim_users", None, "id")
    assert got[4][0] == "dead" and "pk column id" in got[4][2]
    assert got[5][0] == "dead" and got[5][2] == "unknown_sink_type"
    assert got[6][1] == "dwd_shops"
    # outputs are disjoint and cover every valid record
    assert routed.count() == 6
    prepared = {r.source_table + ":" + r.operate_type: list(r.sink_columns)
                for r in routing.prepare_rules(_rules(spark, RULES)).collect()}
    assert prepared["users:insert"] == ["id", "name"]
    import json as _json

    facts = sorted((f.topic, _json.loads(f.value)) for f in routing.fact_messages(routed).collect())
    assert facts == [("dwd_orders", {"id": "1", "amount": "5"}), ("dwd_shops", {"id": "s"})]
    assert rows(routing.unroutable_counts(routed), "table", "type", "n") == [("orders", "UPDATE", 1)]


def test_start_route(spark):
    df = spark.createDataFrame(
        [({"type": "MachineTool_Start"}, None), ({"type": "WeldRobotStart"}, None),
         ({"type": "WeldRobot_Start"}, None), ({"type": "other"}, None), ({"x": "1"}, None),
         ({}, None), (None, "heartbeat"), (None, "shutdown"), (None, None)],
        "start map<string,string>, log_type string",
    )
    got = [r.route for r in routing.with_route(df).collect()]
    assert got == ["machine_start", "weld_start", "weld_start", None, None, None, "heartbeat", "shutdown", None]
    counts = dict(rows(routing.route_counts(routing.with_route(df)), "route", "n"))
    assert counts["main"] == 9 and counts["weld_start"] == 2


# ------------------------------------------------------------------- dims


def test_dim_schema_and_validation():
    assert [f.name for f in dims.dim_schema([" id", "name ", ""], "id").fields] == ["id", "name"]
    with pytest.raises(ValueError):
        dims.dim_schema(["name"], "id")


def test_upsert_snapshot_lww_replay_and_delete(spark, tmp_dir):
    cols = ["id", "name"]
    dims.ensure_dim_table(spark, tmp_dir, "dim_u", cols)
    b0 = spark.createDataFrame(
        [("1", "a", "insert", 1), ("1", "b", "update", 2), ("2", "x", "insert", 3), ("3", "q", "insert", 4)],
        "id string, name string, type string, seq long",
    )
    dims.upsert_dim(spark, b0, tmp_dir, "dim_u", "id", cols, version=1)
    b1 = spark.createDataFrame(
        [("2", None, "delete", 5), ("3", "r", "update", 6), ("4", "n", "insert", 7)],
        "id string, name string, type string, seq long",
    )
    dims.upsert_dim(spark, b1, tmp_dir, "dim_u", "id", cols, version=2)
    snap = dims.read_snapshot(spark, tmp_dir, "dim_u")
    assert rows(snap, "id", "name") == [("1", "b"), ("3", "r"), ("4", "n")]
    # replaying batch 2 starts again from v=1 and rewrites v=2 -> same answer
    dims.upsert_dim(spark, b1, tmp_dir, "dim_u", "id", cols, version=2)
    assert rows(dims.read_snapshot(spark, tmp_dir, "dim_u"), "id", "name") == [("1", "b"), ("3", "r"), ("4", "n")]
    kept = dims.merge_snapshot(None, b1, "id", cols, deletes="upsert")
    assert rows(kept, "id", "name") == [("2", None), ("3", "r"), ("4", "n")]


def test_enrich_miss_keeps_row(spark):
    df = spark.createDataFrame([("m1",), ("m2",), (None,)], "mid string")
    dim = spark.createDataFrame([("m1", "f1"), ("m1", "f1")], "id string, Fid string")
    out = dims.enrich(df, dim, "mid", "id", {"Fid": "fid"})
    assert rows(out, "mid", "fid") == [("m1", "f1"), ("m2", None), (None, None)]


def test_enrich_asof_edges(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    ev = spark.createDataFrame([(1, "e", t(1)), (2, "e", t(5)), (3, "e", t(9)), (4, "z", t(9))],
                               "id long, key string, ts timestamp_ntz")
    dim = spark.createDataFrame([("e", t(2), 10, "v1"), ("e", t(5), 11, "v2"), ("e", t(5), 12, "v3")],
                                "key string, vts timestamp_ntz, vseq long, start string")
    out = dims.enrich_asof(ev, dim, "key", "ts", "key", "vts", "vseq", ["start"], bucket_ms=3600 * 1000)
    assert rows(out, "id", "vseq", "start") == [(1, None, None), (2, 12, "v3"), (3, 12, "v3"), (4, None, None)]


# ---------------------------------------------------------------- inspect


def test_interval_join_bounds_and_symmetry(spark):
    base = dt.datetime(2024, 1, 1, 12)
    ms = lambda k: base + dt.timedelta(milliseconds=k)
    info = spark.createDataFrame([("o1", 1, base), ("o2", 2, base), (None, 3, base)], "oid string, iid long, its timestamp_ntz")
    det = spark.createDataFrame(
        [("o1", 10, ms(-5000)), ("o1", 11, ms(0)), ("o1", 12, ms(5000)), ("o1", 13, ms(-5001)),
         ("o1", 14, ms(5001)), ("o1", 15, ms(0)), ("o3", 16, ms(0)), (None, 17, ms(0))],
        "doid string, did long, dts timestamp_ntz",
    )
    j = inspect.interval_join(info, det, "oid", "its", "dts", -5000, 5000, right_key="doid")
    assert [r[0] for r in rows(j, "did")] == [10, 11, 12, 15]
    swapped = inspect.interval_join(det, info, "doid", "dts", "its", -5000, 5000, right_key="oid")
    assert rows(swapped, "did") == rows(j, "did")
    fine = inspect.interval_join(info, det, "oid", "its", "dts", -5000, 5000, bucket_ms=700, right_key="doid")
    assert rows(fine, "did") == rows(j, "did")


def test_size_feeds(spark):
    d = spark.createDataFrame(
        [("m", "s1", "1", "1", 1, "a"), ("m", "s1", "1", "1", 2, "b"), ("m", "s1", "1", "0", 3, "c"),
         ("m", "s2", "1", None, 4, "d")],
        "mid string, size_id string, isNew string, isPass string, ts long, detail_id string",
    ).withColumn("day", F.lit(D(2024, 1, 1)))
    first = inspect.first_defect_per_size(d, order=["ts"])
    assert rows(first, "size_id", "ts") == [("s1", 3), ("s2", 4)]
    re = inspect.recheck_rows(d, order=["ts", "detail_id"])
    assert [r[0] for r in rows(re, "detail_id")] == ["b", "c"]
    assert rows(inspect.recheck_counts(d), "size_id", "n_recheck") == [("s1", 2)]


# ------------------------------------------------------------------ stats


def test_normalise_measures(spark):
    df = spark.createDataFrame([("m", "1", "1", 0), ("m", "1", "0", 0), ("m", "1", None, 0)],
                               "mid string, isNew string, isPass string, ts long")
    keep = ["mid", "isNew"]
    got = {f: rows(stats.normalise(df, f, keep), "isNew", "defect_sum", "check_sum", "defect_type_count",
                   "double_sum", "double_fail_sum") for f in ("detail", "per_size", "recheck")}
    assert sorted(r[1:] for r in got["detail"]) == [(0, 1, 0, 0, 0), (1, 1, 0, 0, 0), (1, 1, 0, 0, 0)]
    assert {r[1:] for r in got["per_size"]} == {(0, 0, 1, 0, 0)}
    assert sorted(r[1:] for r in got["recheck"]) == [(0, 0, 0, 1, 0), (0, 0, 0, 1, 1), (0, 0, 0, 1, 1)]


def test_window_edges(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame(
        [("f", "l", "t", "e", "1", t0, 1), ("f", "l", "t", "e", "1", t0 + dt.timedelta(seconds=10), 1)],
        "fid string, lid string, mtype string, eid string, isnew string, ts timestamp_ntz, defect_sum long",
    )
    for m in ("check_sum", "defect_type_count", "double_sum", "double_fail_sum"):
        df = df.withColumn(m, F.lit(0).cast("long"))
    out = rows(stats.size_stats(df, "ts", "10 seconds"), "wbt", "wet", "defect_sum")
    assert out == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", 1), ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 1)]


def test_uptime_sessions(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    beats = spark.createDataFrame([("e", t(0)), ("e", t(3)), ("e", t(9)), ("e", t(20)), ("e", t(23))],
                                  "eq string, ts timestamp_ntz")
    got = rows(stats.uptime_sessions(beats, "eq", "ts", "6 minutes"), "first_beat", "n_beats", "uptime_us")
    # a beat exactly one gap after the previous one still belongs to it
    assert got == [(t(0), 3, 540_000_000), (t(20), 2, 180_000_000)]


def test_sessions_exact_across_buckets(spark):
    """Bucketed sessions equal a brute-force scan, with gaps at, below and
    above the bound."""
    import random

    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    recs, t = [], {}
    for i in range(300):
        k = f"e{rnd.randint(0, 2)}"
        t[k] = t.get(k, 0) + rnd.choice([60, 180, 360, 361, 900, 4000])
        recs.append((k, base + dt.timedelta(seconds=t[k])))
    df = spark.createDataFrame(recs, "eq string, ts timestamp_ntz")
    want = []
    for k in sorted({r[0] for r in recs}):
        ts = sorted(r[1] for r in recs if r[0] == k)
        cur = [ts[0]]
        for x in ts[1:]:
            if (x - cur[-1]).total_seconds() > 360:
                want.append((k, cur[0], cur[-1], len(cur)))
                cur = []
            cur.append(x)
        want.append((k, cur[0], cur[-1], len(cur)))
    got = rows(stats.uptime_sessions(df, "eq", "ts", "6 minutes"), "eq", "first_beat", "last_beat", "n_beats")
    assert got == sorted(want)


def test_names_and_point_lookup(spark):
    from millrun.functions.names import rename_columns, to_camel, to_snake

    assert to_camel("sink_table") == "sinkTable" and to_camel("id") == "id"
    assert to_snake("sinkTable") == "sink_table"
    df = spark.createDataFrame([("a", "b")], "source_table string, sink_type string")
    assert rename_columns(df).columns == ["sourceTable", "sinkType"]
    dim = spark.createDataFrame([("1", "x", 1), ("1", "y", 2), ("2", "z", 1)], "id string, v string, s long")
    assert [r.v for r in dims.point_lookup(dim, "id", "1", "s").collect()] == ["y"]
    assert dims.point_lookup(dim, "id", "9").count() == 0


def test_parse_inspections(spark):
    from millrun.operators import parse

    text = spark.createDataFrame([('{"orderId": "o1", "ts": 5}',), ('{"ts": 5}',), ("nope",)], "value string")
    out = {r.raw: (r.orderId, r.ts, r.dead_reason) for r in parse.parse_inspections(text).collect()}
    assert out['{"orderId": "o1", "ts": 5}'] == ("o1", 5, None)
    assert out['{"ts": 5}'][2] == "no_orderId"
    assert out["nope"][2] == "malformed_json"


def test_equipment_log_dead_letter_reasons(spark):
    from millrun.operators import parse

    lines = [
        '{"common": {"part_id": "p", "is_new": 1, "ts": "2024-01-01 10:00:00"}, "start": {"type": "x"}}',
        '{"common": {"part_id": "p", "is_new": "1", "ts": "junk"}}',
        '{"common": {"is_new": "1", "ts": "2024-01-01"}}',
        '{"common": 5}',
        '{"start": {}}',
        '{"common": {"part_id": "p", "ts": "1704103200000"}, "log_type": "heartbeat"}',
        "not json",
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "seq long, value string")
    got = {r.seq: (r.dead_reason, r.is_new, str(r.log_date)) for r in parse.parse_equipment_logs(df).collect()}
    assert got[0] == (None, "1", "2024-01-01")  # number read as text
    assert got[1][0] == "bad_ts"
    assert got[2][0] == "no_part_id"
    assert got[3][0] in ("malformed_json", "no_common")
    assert got[4][0] == "no_common"
    assert got[5] == (None, None, "2024-01-01")  # epoch-ms text
    assert got[6][0] == "malformed_json"
    assert parse.good(parse.parse_equipment_logs(df)).count() == 2


def test_merge_snapshot_column_level(spark):
    cols = ["id", "name", "city"]
    cur = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")], "id string, name string, city string")
    ch = spark.createDataFrame(
        [("1", None, "x2", "update", 5, False, True),    # only city carried
         ("1", "a3", None, "update", 7, True, False),    # only name carried
         ("2", None, None, "delete", 6, False, False),   # removed
         ("3", None, None, "delete", 4, False, False),   # removed, then rebuilt
         ("3", "c2", None, "insert", 8, True, False),
         ("4", "n", "q", "insert", 9, True, True),
         ("5", None, "w", "update", 3, True, True)],     # name explicitly NULL
        "id string, name string, city string, type string, seq long, _has_name boolean, _has_city boolean",
    )
    got = rows(dims.merge_snapshot(cur, ch, "id", cols), "id", "name", "city")
    assert got == [("1", "a3", "x2"), ("3", "c2", None), ("4", "n", "q"), ("5", None, "w")]
