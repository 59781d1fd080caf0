"""The batch jobs end to end on the smallest supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF001
from millrun.plans import jobs
from millrun.plans import standins as si


def test_batch_jobs_write_layers(spark, tmp_dir):
    e1 = jobs.e1_equipment_logs(si.equipment_log_text(spark, SF001))
    e3 = jobs.e3_unique_parts(si.manufacture_log_text(spark, SF001))
    e6 = jobs.e6_part_stats(e1["main"].select("part_id", "log_date", "is_new"))
    jobs.write_outputs({"dwd_equipment_log": e1["main"].drop("start", "common"),
                        "dwd_machine_start_log": e1["machine_start"].select("seq", "value"),
                        "dwm_unique_part": e3["unique_part"], "daily_parts": e3["daily_parts"],
                        "part_stats": e6}, tmp_dir)
    events = spark.read.parquet(f"{SF001}/events.parquet")
    assert spark.read.parquet(f"{tmp_dir}/dwd_equipment_log").count() == events.count()
    assert spark.read.parquet(f"{tmp_dir}/dwd_machine_start_log").count() == events.filter("event_type = 'signup'").count()
    n_pairs = events.select("user_id", F.to_date("ts")).distinct().count()
    assert spark.read.parquet(f"{tmp_dir}/dwm_unique_part").count() == n_pairs
    assert spark.read.parquet(f"{tmp_dir}/part_stats").agg(F.sum("n_records")).first()[0] == events.count()
    assert e1["dead_letter"].count() == 0


def test_dim_rules_with_different_columns_share_one_upsert(spark, tmp_dir):
    from millrun.operators import dims
    from millrun.sources.shapes import CHANGE_RECORD, RULE

    rules = spark.createDataFrame(
        [("users", "insert", "hbase", "dim_users", "id,name", None, None, 1),
         ("users", "update", "hbase", "dim_users", "id,city", None, None, 1)], RULE)
    cdc = spark.createDataFrame(
        [("users", "insert", 0, 1, {"id": "u1", "name": "a", "city": "x"}),
         ("users", "update", 0, 2, {"id": "u1", "city": "y"}),
         ("users", "insert", 0, 3, {"id": "u2", "name": "b"})], CHANGE_RECORD)
    out = jobs.e2_change_records(cdc, rules)
    assert jobs.e2_apply_dims(spark, out["dim_changes"], rules, tmp_dir, 1) == ["dim_users"]
    snap = dims.read_snapshot(spark, tmp_dir, "dim_users")
    assert snap.columns == ["id", "name", "city"]
    got = sorted(tuple(r) for r in snap.select("id", "name", "city").collect())
    # the update carried only "city": "name" keeps its stored value
    assert got == [("u1", "a", "y"), ("u2", "b", None)]
