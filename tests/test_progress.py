"""Completion progress, mergeable counts of parts, and windows cut by density."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrun.operators import dims, keyed, parts
from millrun.plans import jobs as bjobs
from millrun.streaming import io
from millrun.streaming import jobs as sjobs

D0 = dt.date(2024, 1, 1)
STEP = "part string, day date, step int"


def _steps(seed, n, top):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "b", "HOT", "HOT", None]), D0 + dt.timedelta(days=rnd.randrange(9)), rnd.choice([None, -1, 0, top + 1, *range(1, top + 1)])) for _ in range(n)]


def _plain_progress(records, steps, planned):
    out = []
    for part in {r[0] for r in records}:
        done: set = set()
        for day in sorted({r[1] for r in records if r[0] == part}):
            today = [r[2] for r in records if r[0] == part and r[1] == day]
            before = len(done)
            done |= {s for s in today if s is not None and 1 <= s <= steps}
            missing = [s for s in range(1, planned + 1) if s not in done]
            out.append((part, day, len(today), len(done) - before, len(done), planned, missing, (planned - len(missing)) / planned if planned else None))
    return sorted(out, key=lambda r: (r[0] is None, r[0], r[1]))


@pytest.mark.parametrize(("steps", "planned"), [(7, 7), (64, 64), (65, 65), (130, 100), (7, 0)])
def test_completion_progress(spark, steps, planned):
    records = _steps(steps, 400, steps)
    df = spark.createDataFrame(records, STEP).repartition(4)
    halves = [parts.step_masks(df.filter(F.pmod(F.xxhash64("step", "day"), F.lit(2)) == i), "part", "day", "step", steps) for i in (0, 1)]
    merged = parts.merge_masks(halves[0].unionByName(halves[1]), "part", "day", steps)
    for masks in (parts.step_masks(df, "part", "day", "step", steps), merged):
        got = parts.completion_progress(masks, "part", "day", steps, F.lit(planned))
        assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0], r[1])) == _plain_progress(records, steps, planned)


def test_completion_stream_ends_where_the_batch_ends(spark, tmp_dir):
    records = [r for r in _steps(3, 200, 70) if r[0]]
    for i in range(4):
        with open(f"{tmp_dir}/part-{i}.json", "w") as f:
            f.write("\n".join(json.dumps({"part": p, "step": s}) for p, _, s in records[i::4]) + "\n")
    stream = spark.readStream.schema("part string, step int").option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/part-*.json")
    q = (parts.completion_stream(stream, "part", "step", 70).writeStream.format("memory").queryName("steps").outputMode("update")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    last = keyed.last_per_key(spark.table("steps"), ["part"], ["n_records"])
    batch = parts.completion_progress(parts.step_masks(spark.createDataFrame(records, STEP), "part", "day", "step", 70), "part", "day", 70)
    final = {r.part: (r.n_done, r.missing) for r in batch.orderBy("day").collect()}
    assert {r.part: (r.n_done, r.missing) for r in last.collect()} == final


def test_steps_are_one_partial_hash_aggregate(spark):
    plan = parts.step_masks(spark.createDataFrame(_steps(1, 10, 7), STEP), "part", "day", "step", 70)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan


# ------------------------------------------------------------------ sketches


def _daily(seed, n, kinds):
    rnd = random.Random(seed)
    return [(f"p{rnd.randrange(kinds)}", D0 + dt.timedelta(days=rnd.randrange(45))) for _ in range(n)] + [(None, D0)]


def test_estimates_from_daily_sketches_are_within_their_bound(spark):
    df = spark.range(400_000).select(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(60_000))).alias("part_id"), F.date_add(F.lit(D0), F.pmod(F.hash("id"), F.lit(45))).alias("mdate")
    )
    got = parts.checked_period_parts(df, parts.daily_part_sketches(df)).collect()
    assert {r.period for r in got} == {"day", "week", "month"} and len(got) == 45 + 7 + 2
    assert all(r.within_bound for r in got) and max(r.n_parts for r in got) > 50_000
    coarse = parts.checked_period_parts(df, parts.daily_part_sketches(df, lg_k=4))  # the bound of finer ones does not hold
    assert not all(r.within_bound for r in coarse.collect())


def test_stream_of_sketches_counts_like_the_batch(spark, tmp_dir):
    records = _daily(5, 3_000, 200)
    for i in range(3):
        with open(f"{tmp_dir}/part-{i}.json", "w") as f:
            f.write("\n".join(json.dumps({"part_id": p, "mdate": str(d)}) for p, d in records[i::3]) + "\n")
    schema = "part_id string, mdate date"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/part-*.json")
    sjobs.start_part_sketches(stream, f"{tmp_dir}/sketches", trigger={"availableNow": True}, checkpoint=f"{tmp_dir}/ckpt").awaitTermination()
    stored = spark.read.parquet(f"{tmp_dir}/sketches")
    assert stored.select("batch").distinct().count() == 3
    df = spark.createDataFrame(records, schema)
    got = parts.period_parts(parts.merge_sketches(stored))
    want = parts.period_parts(parts.daily_part_sketches(df))
    assert rows(got) == rows(want)
    exact = {r.mdate: r.n for r in df.groupBy("mdate").agg(F.countDistinct("part_id").alias("n")).collect()}
    assert {r.start: r.n_estimate for r in got.filter("period = 'day'").collect()} == exact  # so few are counted exactly


# ------------------------------------------------------------------- density


def _in_one_hour(n_cold=40, per_cold=30):
    """A third of all rows is one part's, in one hour of a month; the others' are spread."""
    hot = n_cold * per_cold // 2
    start = dt.datetime(2024, 1, 10, 12)
    recs = [("HOT", start + dt.timedelta(seconds=3600 * i / hot), i) for i in range(hot)]
    rnd = random.Random(2)
    recs += [(f"c{k}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(30 * 86_400)), hot + k * per_cold + j) for k in range(n_cold) for j in range(per_cold)]
    return recs


def _valued(spark, recs):
    df = spark.createDataFrame(recs, "k string, t timestamp, seq long").repartition(6)
    return df.withColumn("v", F.when(F.pmod(F.xxhash64("seq"), F.lit(3)) == 0, F.col("seq")))


@pytest.mark.parametrize("key_rows", [10, 100, 1_000_000])
def test_previous_value_by_density(spark, key_rows):
    df = _valued(spark, _in_one_hour())
    got = keyed.prev_value_by_density(df, ["k"], ["t", "seq"], "v", "prev", key_rows)
    w = Window.partitionBy("k").orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got, "k", "seq", "prev") == rows(df.withColumn("prev", F.last("v", ignorenulls=True).over(w)), "k", "seq", "prev")
    shuffled = keyed.prev_value_by_density(df, ["k"], ["t", "seq"], "v", "prev", key_rows, max_rows=0)
    assert rows(shuffled, "k", "seq", "prev") == rows(got, "k", "seq", "prev")


def test_a_hot_hour_is_spread_over_all_tasks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = keyed.prev_value_by_density(_valued(spark, _in_one_hour()), ["k"], ["t", "seq"], "v", "prev", 100)
        placed = out.filter("k = 'HOT'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("prev"))  # prev keeps the window
        tasks = {r.p: r.n for r in placed.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(tasks) == 16 and max(tasks.values()) < 3 * 600 / 16


def test_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = _valued(spark, _in_one_hour())
    counted = df.mapInPandas(count, df.schema)
    assert keyed.prev_value_by_density(counted, ["k"], ["t", "seq"], "v", "prev", 100).count() == df.count() == seen.value


def test_rows_without_a_key_have_no_previous_value(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "x"), ("a", 2, None), ("a", 3, "y")], "k string, seq long, v string")
    got = keyed.prev_value_by_density(df, ["k"], ["seq"], "v", "prev", 1)
    assert rows(got, "k", "seq", "prev") == rows(spark.createDataFrame([(None, 1, None), (None, 2, None), ("a", 1, None), ("a", 2, "x"), ("a", 3, "x")], "k string, seq long, prev string"))
    assert keyed.prev_value_by_density(df.filter("false"), ["k"], ["seq"], "v", "prev").count() == 0


def test_asof_of_a_hot_hour(spark, monkeypatch):
    monkeypatch.setattr(keyed.prev_value_by_density, "__defaults__", (50, keyed.BROADCAST_MAX_ROWS))
    df = _valued(spark, _in_one_hour())
    facts, versions = df.filter("v IS NULL").select("k", "t", "seq"), df.filter("v IS NOT NULL").select(F.col("k").alias("id"), F.col("t").alias("vt"), F.col("seq").alias("vs"), "v")
    got = dims.enrich_asof(facts, versions, "k", "t", "id", "vt", "vs", ["v"])
    fixed = dims.enrich_asof(facts, versions, "k", "t", "id", "vt", "vs", ["v"], bucket_ms=3_600_000)
    assert rows(got) == rows(fixed)


def test_batch_and_stream_share_the_queues_order(spark, tmp_dir):
    """The order of arrival that the queue gives (text) serves E3's batch replay and its stream."""
    base = 1_704_067_200_000
    day = 86_400_000
    recs = [("a", base, 1, 0), ("a", base + day, 0, 7), ("a", base, 1, 9), ("b", base, 0, 3), ("a", base + 5, 1, 12), ("b", base + day, 1, 4)]
    arrivals = spark.createDataFrame([(json.dumps({"common": {"partId": p}, "ts": t}), i, q, o) for i, (p, t, q, o) in enumerate(recs)], "value string, i long, p int, o long")
    text = arrivals.select("value", io.arrival(F.timestamp_millis(F.lit(base) + F.col("i")), F.col("p"), F.col("o")).alias("seq"))
    batch = bjobs.e3_unique_parts(text)["unique_part"]
    assert [r.value for r in batch.orderBy("seq").collect()] == [r.value for r in text.orderBy("seq").collect() if json.loads(r.value)["ts"] != base + 5]
    os.makedirs(f"{tmp_dir}/src")
    text.coalesce(1).write.mode("overwrite").json(f"{tmp_dir}/src")
    stream = spark.readStream.schema(text.schema).json(f"{tmp_dir}/src")
    q = sjobs.e3_stream(stream, cleanup=False).writeStream.format("memory").queryName("e3_arrival").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("e3_arrival"), "seq", "value") == rows(batch, "seq", "value")
