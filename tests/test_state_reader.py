"""The state of a stream, read back from its checkpoint."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from millrun.operators import parse
from millrun.streaming import jobs as sjobs
from millrun.streaming.io import file_text_source
from millrun.streaming.state_reader import keyed_state, state_differences

DAY = 86_400_000
BASE = 1_704_067_200_000


def _write(src: str, name: str, recs: list[tuple]) -> None:
    os.makedirs(src, exist_ok=True)
    with open(f"{src}/{name}.json", "w") as f:
        f.write("".join(json.dumps({"common": {"partId": p}, "ts": t, "seq": i}) + "\n" for p, t, i in recs))


def _run(spark, src, out, ckpt, name):
    q = sjobs.start_e3(file_text_source(spark, src), out, name=name, trigger={"availableNow": True}, checkpoint=ckpt, cleanup=False)
    q.awaitTermination()


def _expected(spark, src):
    logs = parse.good(parse.parse_manufacture_logs(spark.read.text(src)))
    days = logs.select("part_id", "seq", F.date_format("mdate", "yyyy-MM-dd").alias("day"))
    return days.groupBy("part_id").agg(F.max_by("day", "seq").alias("last_day"))


def test_state_after_a_restart_is_what_a_batch_says(spark, tmp_dir):
    src, out, ckpt = (f"{tmp_dir}/{x}" for x in ("src", "out", "ckpt"))
    _write(src, "a", [("a", BASE, 0), ("b", BASE, 1), ("a", BASE + DAY, 2)])
    _run(spark, src, out, ckpt, "state_a")
    before = _expected(spark, src).collect()
    _write(src, "b", [("b", BASE + 2 * DAY, 3), ("c", BASE, 4), ("a", BASE, 5)])
    _run(spark, src, out, ckpt, "state_b")

    now = keyed_state(spark, ckpt)
    assert state_differences(now, _expected(spark, src), ["part_id"], ["last_day"]).count() == 0
    assert {r.part_id: r.last_day for r in now.collect()} == {"a": "2024-01-01", "b": "2024-01-03", "c": "2024-01-01"}
    old = keyed_state(spark, ckpt, batch_id=0)
    assert sorted((r.part_id, r.last_day) for r in old.collect()) == sorted(map(tuple, before))
    changed = state_differences(old, now, ["part_id"], ["last_day"]).collect()
    assert {(r.part_id, r.state and r.state.last_day, r.expected.last_day) for r in changed} == {
        ("a", "2024-01-02", "2024-01-01"), ("b", "2024-01-01", "2024-01-03"), ("c", None, "2024-01-01"),
    }


def test_differences_of_null_keys(spark):
    one = spark.createDataFrame([(None, "x"), ("k", None)], "part_id string, last_day string")
    two = spark.createDataFrame([(None, "x"), ("k", "y")], "part_id string, last_day string")
    assert state_differences(one, one, ["part_id"], ["last_day"]).count() == 0
    (row,) = state_differences(one, two, ["part_id"], ["last_day"]).collect()
    assert row.part_id == "k" and row.state.last_day is None and row.expected.last_day == "y"
