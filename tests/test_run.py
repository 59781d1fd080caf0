"""The command-line launcher runs the streaming jobs from topic folders."""

from __future__ import annotations

import json
import os

from millrun import run


def _topic(root: str, name: str, recs: list[dict]) -> None:
    os.makedirs(f"{root}/{name}", exist_ok=True)
    with open(f"{root}/{name}/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")


def test_run_e3_and_e5_once(spark, tmp_dir):
    base, day = 1_704_067_200_000, 86_400_000
    _topic(tmp_dir + "/in", "dwd_manufacture_log",
           [{"common": {"partId": "a"}, "ts": base, "seq": 0}, {"common": {"partId": "a"}, "ts": base + 1, "seq": 1},
            {"common": {"partId": "a"}, "ts": base + day, "seq": 2}])
    assert run.main(["e3", "--source", "files", "--input", f"{tmp_dir}/in", "--out", f"{tmp_dir}/out", "--once"],
                    spark) == 0
    got = spark.read.json(f"{tmp_dir}/out/dwm_unique_part").collect()
    assert sorted(r.seq for r in got) == [0, 2]

    for t, recs in zip(run.TOPICS["e5"], [
        [{"mid": "m1", "isNew": "1", "isPass": "0", "ts": base}, {"mid": "m1", "isNew": "1", "isPass": "1", "ts": base + 2 * day}],
        [{"mid": "m1", "isNew": "1", "isPass": "0", "ts": base + 1}],
        [{"mid": "m1", "isNew": "1", "isPass": "0", "ts": base + 2}],
    ]):
        _topic(tmp_dir + "/in", t, [*recs, {"ts": base}])
    with open(f"{tmp_dir}/in/{run.TOPICS['e5'][0]}/bad.json", "w") as f:
        f.write("broken{\n")
    spark.createDataFrame([("m1", "e1", "f1", "t1", "l1")], "id string, eId string, Fid string, mType string, lid string") \
        .write.parquet(f"{tmp_dir}/prod")
    assert run.main(["e5", "--source", "files", "--input", f"{tmp_dir}/in", "--out", f"{tmp_dir}/out",
                     "--production", f"{tmp_dir}/prod", "--window", "1 day", "--once"], spark) == 0
    w = spark.read.json(f"{tmp_dir}/out/dws_size_stats").collect()
    first = [r for r in w if r.wbt == "2024-01-01 00:00:00"]
    assert [(r.defect_sum, r.check_sum, r.defect_type_count, r.double_sum, r.double_fail_sum) for r in first] == [(1, 1, 1, 1, 1)]
    dead = [r.dead_reason for r in spark.read.json(f"{tmp_dir}/out/dead_letter").collect()]
    assert sorted(x for x in dead if x) == ["malformed_json", "no_mid", "no_mid", "no_mid"]


def test_run_e4_with_equipment_dim(spark, tmp_dir):
    import datetime as dt

    base = 1_704_067_200_000
    _topic(tmp_dir + "/in", "dwd_inspect_info", [{"orderId": "o1", "ts": base, "equipmentId": "q1"}])
    _topic(tmp_dir + "/in", "dwd_inspect_detail",
           [{"orderId": "o1", "ts": base + 4000, "equipmentId": "q1"}, {"orderId": "o1", "ts": base + 9000, "equipmentId": "q1"}])
    spark.createDataFrame([("q1", dt.date(2023, 12, 22))], "id string, start_date date").write.parquet(f"{tmp_dir}/eq")
    assert run.main(["e4", "--source", "files", "--input", f"{tmp_dir}/in", "--out", f"{tmp_dir}/out",
                     "--equipment", f"{tmp_dir}/eq", "--once"], spark) == 0
    got = spark.read.json(f"{tmp_dir}/out/dwm_inspect_wide").collect()
    assert [(r.detail_ts - base, r.working_days) for r in got] == [(4000, 10)]
