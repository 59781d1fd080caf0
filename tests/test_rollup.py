"""Measures without a fan-out, and sums rolled up along periods and levels."""

from __future__ import annotations

import json
import os
import random
from collections import Counter

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from millrun.operators import rollup, stats
from millrun.plans.catalog import QUERIES
from millrun.sources.shapes import MEASURES
from millrun.streaming import jobs as sjobs

BASE = 1_704_067_200_000  # 2024-01-01
HOUR = 3_600_000
FEED = "mid string, isNew string, isPass string, ts long"
PRODUCTION = "id string, eId string, Fid string, mType string, lid string"


def test_measures_once_sum_like_the_feeds(spark):
    rnd = random.Random(4)
    records = [(rnd.choice("ab"), rnd.choice(["1", "0", None]), rnd.choice([True, False, None]), rnd.choice([True, False, None])) for _ in range(300)]
    df = spark.createDataFrame(records, "k string, isPass string, x boolean, y boolean")
    member = {"detail": F.col("x"), "per_size": F.col("y"), "recheck": F.col("x") & F.col("y")}
    sums = [F.sum(m).alias(m) for m in MEASURES]
    once = stats.measures_once(df, member, ["k", "isPass"])
    assert rows(once.groupBy("k", "isPass").agg(*sums)) == rows(stats.normalise_once(df, member, ["k", "isPass"]).groupBy("k", "isPass").agg(*sums))
    assert once.count() == df.filter("x OR y").count()
    with pytest.raises(ValueError, match="unknown feed"):
        stats.measures_once(df, {"other": F.lit(True)}, ["k"])


def _records(seed):
    rnd = random.Random(seed)
    return [(rnd.choice(["m1", "m2", "m3", "HOT", "HOT", "HOT", None]), "1", rnd.choice(["1", "0", None]), BASE + rnd.randrange(50 * HOUR)) for _ in range(600)]


#: m3 is no production of the dim, m2 has no line: two levels with a NULL.
DIM = [("m1", "e1", "f1", "weld", "l1"), ("m2", "e2", "f1", "weld", None), ("HOT", "e3", "f2", "cut", "l3")]


def _plain(records, length):
    dim = {i: (f, line, m, e) for i, e, f, m, line in DIM}
    out = Counter()
    for mid, _, is_pass, ts in records:
        keys = dim.get(mid, (None,) * 4)
        for depth, level in enumerate(rollup.LEVELS):
            at = (ts // length * length, level, *keys[:depth], *(None,) * (4 - depth))
            out[(*at, "checks")] += 1
            out[(*at, "defects")] += is_pass != "1"
    return {k: n for k, n in out.items() if n}


def _found(df, until=None):
    out = Counter()
    for r in df.withColumn("at", F.unix_millis(F.to_timestamp("wbt"))).collect():
        if until is None or r.at < until:
            out[(r.at, r.level, r.fid, r.lid, r.mtype, r.eid, "checks")] += r.check_sum
            out[(r.at, r.level, r.fid, r.lid, r.mtype, r.eid, "defects")] += r.defect_sum
    return {k: n for k, n in out.items() if n}


def test_levels_and_periods_against_plain_python(spark):
    records = _records(1)
    df = spark.createDataFrame([*records, ("m1", "1", "1", None)], FEED).select("mid", "isPass", F.timestamp_millis("ts").alias("ts"))
    production = spark.createDataFrame(DIM, PRODUCTION)
    lookup = [(production, "mid", "id", {"Fid": "fid", "lid": "lid", "mType": "mtype", "eId": "eid"})]
    feed = stats.measures_once(df, {"detail": F.lit(True)}, ["mid", "ts"])
    hours, days = rollup.chained_sums(feed, lookup, grain=("mid",))
    assert _found(rollup.by_level(hours, "hour")) == _plain(records, HOUR)
    assert _found(rollup.by_level(days, "day")) == _plain(records, 24 * HOUR)
    none = rollup.chained_sums(feed.limit(0), lookup, grain=("mid",))[-1]
    assert rollup.by_level(none, "day").isEmpty()


def test_periods_must_divide(spark):
    feed = spark.createDataFrame([], "mid string, ts timestamp")
    for periods in (("10 seconds",), ("7 seconds", "1 minute"), ("1 day", "1 hour")):
        with pytest.raises(ValueError, match="multiple"):
            rollup.chained_sums(feed, [], periods=periods)


@pytest.mark.parametrize("files", [1, 5])
def test_chained_stream_equals_batch(spark, tmp_dir, files):
    """Ten seconds to hours to days in one stream, stopped and resumed between the files."""
    records = sorted(_records(2), key=lambda r: r[3])
    parts = [records[i * len(records) // files : (i + 1) * len(records) // files] for i in range(files)]
    parts.append([("tick", "1", "1", BASE + 200 * HOUR)])
    production = spark.createDataFrame(DIM, PRODUCTION)
    empty = spark.createDataFrame([], FEED)
    os.makedirs(f"{tmp_dir}/none")
    empty.write.mode("overwrite").json(f"{tmp_dir}/none")
    os.makedirs(f"{tmp_dir}/in")
    for i, part in enumerate(parts):
        with open(f"{tmp_dir}/in/part-{i}.json", "w") as f:
            f.write("\n".join(json.dumps(dict(zip(("mid", "isNew", "isPass", "ts"), r))) for r in part) + "\n")
        stream = [spark.readStream.schema(FEED).json(f"{tmp_dir}/{n}") for n in ("in", "none", "none")]
        out = sjobs.e5_rollup_stream(*stream, production)
        sjobs.start_e5(out, f"{tmp_dir}/out", f"rollup_{files}_{i}", {"availableNow": True}, f"{tmp_dir}/ckpt").awaitTermination()
    got = spark.read.schema(out.schema).json(f"{tmp_dir}/out")
    assert _found(got, BASE + 100 * HOUR) == _plain(records, 24 * HOUR)


def test_later_periods_start_from_the_written_sums(spark):
    plan = QUERIES["q_size_rollup"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "supplier.parquet" not in plan  # they were read to write the hours
    assert plan.count("FileScan") == 2  # hours, and days from hours
