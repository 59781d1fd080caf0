"""Cases that earlier versions got wrong."""

from __future__ import annotations

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F

from millrun.functions.jsonfn import with_member
from millrun.operators import dims, inspect, stats
from millrun.plans.jobs import e1_equipment_logs, e3_unique_parts


def _submitted(tmp_path, code, *conf):
    """Run ``code`` as a submitted program and return what it prints last."""
    program = tmp_path / "program.py"
    program.write_text(f"import sys; sys.path.insert(0, {ROOT!r})\n{code}")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_ENV"))}
    args = " ".join(f"--conf {c}" for c in conf)
    env["PYSPARK_SUBMIT_ARGS"] = f"--master local[2] --driver-memory 1g {args} --conf spark.ui.enabled=false pyspark-shell"
    done = subprocess.run([sys.executable, str(program)], env=env, capture_output=True, text=True, timeout=180)
    return done.stdout.strip().splitlines()[-1] if done.stdout.strip() else done.stderr[-2000:]


def test_a_submitted_conf_survives(tmp_path):
    code = """
from millrun.session import build_session
s = build_session()
c = s.sparkContext.getConf()
print(s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"), c.get("spark.driver.memory"), s.conf.get("spark.sql.session.timeZone"), s.conf.get("spark.sql.adaptive.enabled"))
"""
    got = _submitted(tmp_path, code, "spark.sql.shuffle.partitions=77", "spark.sql.session.timeZone=Asia/Tokyo")
    assert got == "local[2] 77 1g Asia/Tokyo true"


def test_a_cluster_master_needs_a_checkpoint_folder():
    from millrun.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_dir(Session())


def test_window_end_where_clocks_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp '2024-03-10 12:00:00' AS ts, 'f' AS fid, " + ", ".join(f"1L AS {m}" for m in stats.MEASURES))
        got = stats.size_stats(df, "ts", "1 day", ["fid"]).first()
        want = df.select(F.date_format(F.window("ts", "1 day").end, "yyyy-MM-dd HH:mm:ss").alias("e")).first()
        assert got.wet == want.e == "2024-03-10 20:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_keys_match_no_dim_version(spark):
    t = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(None, t, 1), ("a", t, 2)], "k string, t timestamp_ntz, e long")
    versions = spark.createDataFrame([(None, t, 1, "none"), ("a", t, 2, "yes")], "dk string, dt timestamp_ntz, s long, v string")
    got = rows(dims.enrich_asof(events, versions, "k", "t", "dk", "dt", "s", ["v"]), "e", "v")
    assert got == [(1, None), (2, "yes")]


def test_recheck_rows_with_null_keys(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "a", 2), ("a", None, 3), (None, "a", 4), (None, None, 5)], "mid string, size_id string, seq long")
    assert rows(inspect.recheck_rows(df, order=["seq"]), "seq") == [(3,), (4,)]


def test_with_member_keeps_all_else(spark):
    text = {"common": {"part_id": "p", "is_new": 1, "operator": {"a": [1, "ü", None]}}, "pressure": 1.5, "none": None, "start": {"type": "a", "k": "7"}}
    df = spark.createDataFrame([(json.dumps(text), '0"x'), ('{"a": 1}', "0"), ("broken{", "0"), ("[1]", "0"), (None, "0")], "raw string, v string")
    got = [r.t for r in df.select(with_member("raw", "common", "is_new", F.col("v")).alias("t")).collect()]
    text["common"]["is_new"] = '0"x'
    assert json.loads(got[0]) == text and got[1:] == [None] * 4


def test_whole_records_go_on(spark):
    log = lambda seq, day, **more: (seq, json.dumps({"common": {"part_id": "p", "is_new": "1", "ts": f"2024-01-0{day} 00:00:00", "operator": "o"}, "pressure": 2, **more}))
    text = spark.createDataFrame([log(1, 1), log(2, 2, deep={"x": [1]})], "seq long, value string")
    got = {r.seq: json.loads(r.value) for r in e1_equipment_logs(text)["main"].collect()}
    assert got[1] == json.loads(log(1, 1)[1])
    want = json.loads(log(2, 2, deep={"x": [1]})[1])
    want["common"]["is_new"] = "0"
    assert got[2] == want
    made = spark.createDataFrame([(1, '{"common": {"partId": "p", "line": 4}, "ts": 86400000, "more": {"a": null}}')], "seq long, value string")
    assert [r.value for r in e3_unique_parts(made)["unique_part"].collect()] == [r.value for r in made.collect()]


# --- the dim store

DIM = "id string, name string, type string, seq long"


def _upsert(spark, root, changes, batch, run="r", columns=("id", "name"), schema=DIM):
    return dims.upsert_dim(spark, spark.createDataFrame(changes, schema), root, "d", "id", list(columns), batch, run=run)


def _now(spark, root, *cols):
    return rows(dims.read_snapshot(spark, root, "d"), *(cols or ("id", "name")))


def test_no_table_is_none_and_a_broken_one_an_error(spark, tmp_dir):
    assert dims.read_snapshot(spark, tmp_dir, "d") is None
    _upsert(spark, tmp_dir, [("1", "a", "insert", 1), ("2", "b", "insert", 2)], 0)
    with open(f"{tmp_dir}/d/log/v=0/broken.parquet", "w") as f:
        f.write("not a file of that kind")
    with pytest.raises(Exception):  # noqa: B017
        _upsert(spark, tmp_dir, [("3", "c", "insert", 3)], 1)
    os.unlink(f"{tmp_dir}/d/log/v=0/broken.parquet")
    assert _now(spark, tmp_dir) == [("1", "a"), ("2", "b")]


def test_deletes_to_empty_stay_deleted(spark, tmp_dir):
    _upsert(spark, tmp_dir, [("1", "a", "insert", 1), ("2", "b", "insert", 2)], 0)
    _upsert(spark, tmp_dir, [("1", None, "delete", 3), ("2", None, "delete", 4)], 1)
    assert _now(spark, tmp_dir) == []
    _upsert(spark, tmp_dir, [("2", "x", "insert", 5)], 2)
    assert _now(spark, tmp_dir) == [("2", "x")]


def test_a_fresh_checkpoint_adds_to_what_is_stored(spark, tmp_dir):
    for batch in range(3):
        _upsert(spark, tmp_dir, [(str(batch), "a", "insert", batch)], batch, run="first")
    _upsert(spark, tmp_dir, [("9", "z", "insert", 1), ("0", "b", "update", 2)], 0, run="second")
    assert _now(spark, tmp_dir) == [("0", "b"), ("1", "a"), ("2", "a"), ("9", "z")]
    # a replay changes nothing
    _upsert(spark, tmp_dir, [("9", "other", "insert", 1)], 0, run="second")
    assert dict(_now(spark, tmp_dir))["9"] == "z"


def test_a_rule_gains_and_loses_columns(spark, tmp_dir):
    _upsert(spark, tmp_dir, [("1", "a", "insert", 1)], 0)
    wide = "id string, name string, city string, type string, seq long"
    _upsert(spark, tmp_dir, [("2", "b", "c", "insert", 2)], 1, columns=("id", "name", "city"), schema=wide)
    _upsert(spark, tmp_dir, [("2", "d", "update", 3)], 2)
    assert _now(spark, tmp_dir, "id", "name", "city") == [("1", "a", None), ("2", "d", "c")]


def test_touched_buckets_only_and_vacuum(spark, tmp_dir):
    from millrun.sources.dimstore import DimStore

    _upsert(spark, tmp_dir, [(str(i), "a", "insert", i) for i in range(200)], 0)
    _upsert(spark, tmp_dir, [("7", "b", "update", 300)], 1)
    assert len([n for n in os.listdir(f"{tmp_dir}/d/data/v=1") if n.startswith("bucket=")]) == 1
    for k in range(2, 6):
        _upsert(spark, tmp_dir, [("7", f"b{k}", "update", 300 + k)], k)
    before = _now(spark, tmp_dir)
    assert DimStore(spark, tmp_dir, "d").vacuum(keep=2) == [1, 2, 3]
    assert _now(spark, tmp_dir) == before and ("7", "b5") in before and len(before) == 200


def test_changes_without_a_key_are_dead_letters(spark):
    from millrun.operators import routing
    from millrun.sources.shapes import RULE

    rules = spark.createDataFrame([("t", "insert", "hbase", "dim_t", "id,k", None, None, 1)], RULE)
    cdc = spark.createDataFrame([("t", "insert", 1, {"id": "1", "k": "a"}), ("t", "insert", 2, {"k": "b"})], "table string, type string, seq long, data map<string,string>")
    assert rows(routing.route_changes(cdc, rules), "seq", "route", "reason") == [(1, "dim", None), (2, "dead", "no_pk")]


def test_broadcast_bound_counts_rows_and_bytes(spark, monkeypatch):
    from millrun.operators import keyed

    df = spark.createDataFrame([(str(i), "x" * 1000, ["y"]) for i in range(10)], "k string, v string, a array<string>")
    assert keyed.sized(df, 10)[1] and not keyed.sized(df, 9)[1]
    monkeypatch.setattr(keyed, "BROADCAST_MAX_BYTES", 5_000)
    assert not keyed.sized(df, 10)[1] and keyed.sized(df.select("k"), 10)[1]
