"""Streams in event-time order: the temporal join and power-on sessions equal
their batch forms whatever the order of arrival, over a restart, with salts;
a watermark per feed loses no row of a feed that lags."""

from __future__ import annotations

import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrun.operators import dims, stats
from millrun.plans import jobs as bjobs
from millrun.streaming import jobs as sjobs
from millrun.streaming import ordered

BASE = 1_704_067_200_000_000  # 2024-01-01T00:00Z in microseconds
FACT = "k string, us long, n long, note string"
DIM = "id string, us long, seq long, v string, w double"
LAST = BASE + 10_000_000_000


def _files(root, batches, columns):
    os.makedirs(root, exist_ok=True)
    for i, batch in enumerate(batches):
        path = f"{root}/part-{i:04d}.json"
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(dict(zip(columns, r, strict=True))) for r in batch) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # the source takes files by age


def _stream(spark, root, ddl):
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).json(root)


def _timed(df, ntz=False):
    at = F.timestamp_micros("us")
    return df.withColumn("at", at.cast("timestamp_ntz") if ntz else at)


def _run(out, name, ckpt):
    q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return rows(out.sparkSession.table(name))


def _facts_and_changes(seed):
    """Arrival in batches; each record is at most a second late, and facts may come before their dim."""
    rnd = random.Random(seed)
    facts = [(rnd.choice(["a", "b", "HOT", "HOT", "none", None]), BASE + rnd.randrange(9_000) * 1_000_000 + rnd.choice([0, 1, 999]), i, rnd.choice([None, "x\"y", "é"])) for i in range(300)]
    dim = [(rnd.choice(["a", "b", "HOT"]), BASE + rnd.randrange(9_000) * 1_000_000, i, rnd.choice(["p", "q", None]), rnd.choice([None, 0.1, 1e300])) for i in range(90)]
    dim += [("a", facts[0][1], 500, "same instant", 1.5), ("a", facts[0][1], 501, "same instant, later", 2.5)]
    return facts, dim


def _batches(records, at, n):
    """Records sorted by a slightly wrong clock, in n files, and a tick that moves the watermark."""
    rnd = random.Random(1)
    order = sorted(records, key=lambda r: r[at] + rnd.randrange(-1_000_000, 1))
    size = -(-len(order) // n)
    return [order[i * size : (i + 1) * size] for i in range(n)]


@pytest.mark.parametrize(("parts", "salts", "ntz"), [(1, 1, False), (4, 1, True), (5, 3, False)])
def test_temporal_join_equals_batch(spark, tmp_dir, parts, salts, ntz):
    facts, dim = _facts_and_changes(parts)
    end_fact, end_dim = [("end", LAST, -1, None)], [(None, LAST, -1, None, None)]
    # the dim's files come in an order of their own, facts first: at the same trigger they are hours apart
    _files(f"{tmp_dir}/f", _batches(facts, 1, parts) + [end_fact], ["k", "us", "n", "note"])
    _files(f"{tmp_dir}/d", _batches(dim, 1, max(1, parts - 2)) + [end_dim], ["id", "us", "seq", "v", "w"])
    out = ordered.enrich_asof_stream(
        _timed(_stream(spark, f"{tmp_dir}/f", FACT), ntz), _timed(_stream(spark, f"{tmp_dir}/d", DIM), ntz),
        "k", "at", "id", "at", "seq", ["v", "w"], delay="2 seconds", salts=salts,
    )
    # the last record of all is still held back: the watermark lies two seconds before it
    got = _run(out, f"tj_{parts}_{salts}", f"{tmp_dir}/ckpt")
    batch = dims.enrich_asof(_timed(spark.createDataFrame(facts, FACT), ntz), _timed(spark.createDataFrame(dim, DIM), ntz), "k", "at", "id", "at", "seq", ["v", "w"])
    assert out.columns == batch.columns and got == rows(batch)
    assert len(got) == len(facts)
    assert {r[6] for r in got if r[2] == facts[0][2] and facts[0][0] == "a"} <= {"same instant, later"}


def test_temporal_join_goes_on_after_a_restart(spark, tmp_dir):
    facts, dim = _facts_and_changes(9)
    f, d = _batches(facts, 1, 4) + [[("end", LAST, -1, None)]], _batches(dim, 1, 4) + [[(None, LAST, -1, None, None)]]
    got = []
    for n, upto in enumerate((2, 5)):
        _files(f"{tmp_dir}/f", f[:upto], ["k", "us", "n", "note"])
        _files(f"{tmp_dir}/d", d[:upto], ["id", "us", "seq", "v", "w"])
        out = ordered.enrich_asof_stream(
            _timed(_stream(spark, f"{tmp_dir}/f", FACT)), _timed(_stream(spark, f"{tmp_dir}/d", DIM)), "k", "at", "id", "at", "seq", ["v", "w"]
        )
        q = out.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
        got.append(spark.read.schema(out.schema).parquet(f"{tmp_dir}/out").count())
    batch = dims.enrich_asof(_timed(spark.createDataFrame(facts, FACT)), _timed(spark.createDataFrame(dim, DIM)), "k", "at", "id", "at", "seq", ["v", "w"])
    assert 0 < got[0] < got[1] == len(facts)
    assert rows(spark.read.schema(out.schema).parquet(f"{tmp_dir}/out")) == rows(batch)


def test_equipment_start_as_of_the_inspection(spark, tmp_dir):
    day = 86_400_000
    base = BASE // 1000
    _files(f"{tmp_dir}/i", [[("o1", "e1", base + 3 * day), ("o2", "e1", base + day)], [("o3", "e2", base + day), ("z", "e1", base + 9 * day)]], ["orderId", "equipmentId", "ts"])
    _files(f"{tmp_dir}/c", [[("e1", "2023-12-31", base, 1)], [("e1", "2024-01-03", base + 2 * day, 2), (None, None, base + 9 * day, 3)]], ["id", "start_date", "ts", "seq"])
    out = sjobs.e4_equipment_asof_stream(
        _stream(spark, f"{tmp_dir}/i", "orderId string, equipmentId string, ts long"), _stream(spark, f"{tmp_dir}/c", "id string, start_date string, ts long, seq long")
    )
    _run(out, "e4_asof", f"{tmp_dir}/ckpt")
    assert rows(spark.table("e4_asof"), "orderId", "working_days") == [("o1", 1), ("o2", 2), ("o3", None)]


LOG = "machine string, us long, seq long, power string"
MINUTE = 60_000_000


def _logs(seed):
    rnd = random.Random(seed)
    out, seq = [], 0
    for machine in ("m1", "m2", "HOT"):
        at = BASE
        for _ in range(400 if machine == "HOT" else 120):
            at += rnd.choice([0, 1, 20_000_000, MINUTE, 6 * MINUTE, 6 * MINUTE + 1, 20 * MINUTE])
            seq += 1
            out.append((machine, at, seq, rnd.choice(["start", "shutdown", None, None, None, "other"])))
    return out


def _plain_sessions(logs, gap):
    """One record after the other."""
    out = []
    for machine in sorted({r[0] for r in logs}):
        mine = sorted((r for r in logs if r[0] == machine), key=lambda r: (r[1], r[2]))
        runs: list[list] = []
        for r in mine:
            last = runs[-1][-1] if runs else None
            if last is None or r[3] == "start" or last[3] == "shutdown" or r[1] - last[1] > gap:
                runs.append([])
            runs[-1].append(r)
        for run, following in zip(runs, [*runs[1:], None], strict=True):
            if run[-1][3] == "shutdown":
                by = "shutdown"
            elif following is None:
                by = "open"
            else:
                by = "gap" if following[0][1] - run[-1][1] > gap else "start"
            out.append((machine, run[0][1], len(run), run[-1][1] - run[0][1], "start" if run[0][3] == "start" else "record", by))
    return sorted(out)


def _sessions(df):
    return sorted(map(tuple, df.select("machine", F.unix_micros("first_record"), "n_records", "uptime_us", "opened_by", "closed_by").collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_power_on_sessions(spark, seed):
    logs = _logs(seed)
    df = _timed(spark.createDataFrame(logs, LOG)).repartition(4)
    assert _sessions(stats.power_on_sessions(df, "machine", "at", "seq", "power")) == _plain_sessions(logs, 6 * MINUTE)
    assert _sessions(stats.power_on_sessions(_timed(df, True), "machine", "at", "seq", "power", "1 hour")) == _plain_sessions(logs, 60 * MINUTE)


def test_power_on_sessions_without_records(spark):
    df = _timed(spark.createDataFrame([], LOG))
    assert stats.power_on_sessions(df, "machine", "at", "seq", "power").count() == 0


def test_busy_machine_is_spread_and_meets_its_buckets_in_few_rows(spark):
    """All of a busy machine's records but two pieces per bucket are done within their buckets."""
    n = 6_000
    logs = [("HOT", BASE + i * 600_000, i, ["start", None, "shutdown"][i % 3]) for i in range(n)]  # an hour: ten buckets
    df = _timed(spark.createDataFrame(logs, LOG))
    out = stats.power_on_sessions(df, "machine", "at", "seq", "power")
    assert out.count() == n // 3
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    inside = [line for line in plan.splitlines() if "Window [" in line]
    assert sum("_key" in line and ", _b#" in line.split("], [")[1] for line in inside if "], [" in line) >= 2


@pytest.mark.parametrize("parts", [1, 5])
def test_power_on_stream_equals_batch(spark, tmp_dir, parts):
    logs = _logs(7)
    tick = [("tick", BASE + 10**12, 10**9, None)]
    _files(f"{tmp_dir}/l", _batches(logs, 1, parts) + [tick], ["machine", "us", "seq", "power"])
    out = ordered.power_on_sessions_stream(_timed(_stream(spark, f"{tmp_dir}/l", LOG)), "machine", "at", "seq", "power")
    _run(out, f"po_{parts}", f"{tmp_dir}/ckpt")
    batch = stats.power_on_sessions(_timed(spark.createDataFrame(logs, LOG)), "machine", "at", "seq", "power", until="2030-01-01")
    assert _sessions(spark.table(f"po_{parts}")) == _sessions(batch)


FEED = "mid string, isNew string, isPass string, ts long"


def test_a_feed_that_lags_loses_nothing(spark, tmp_dir):
    """The re-check feed is five hours behind the others in every trigger."""
    base, hour = BASE // 1000, 3_600_000
    feeds = {
        "detail": [[("p1", "1", "1", base + h * hour + s * 1000)] for h in (5, 6, 7, 9) for s in (5,)],
        "size": [[("p1", "1", "0", base + h * hour + 6000)] for h in (5, 6, 7, 9)],
        "recheck": [[("p1", "1", "0", base + h * hour + 7000)] for h in (0, 1, 2, 9)],
    }
    for name, batches in feeds.items():
        _files(f"{tmp_dir}/{name}", batches, ["mid", "isNew", "isPass", "ts"])
    production = spark.createDataFrame([("p1", "e1", "f1", "weld", "l1")], "id string, eId string, Fid string, mType string, lid string")
    whole = bjobs.e5_size_stats(*[spark.read.schema(FEED).json(f"{tmp_dir}/{n}") for n in feeds], production)
    want = rows(whole.filter(F.col("wbt") < "2024-01-01 09"), "wbt", "check_sum", "defect_type_count", "double_sum")
    got = {}
    for per_feed in (True, False):
        out = sjobs.e5_stream(*[_stream(spark, f"{tmp_dir}/{n}", FEED) for n in feeds], production, per_feed=per_feed)
        _run(out, f"feeds_{per_feed}", f"{tmp_dir}/ckpt-{per_feed}")
        got[per_feed] = rows(spark.table(f"feeds_{per_feed}"), "wbt", "check_sum", "defect_type_count", "double_sum")
    assert got[True] == want
    assert sum(r[3] for r in got[False]) < sum(r[3] for r in want)  # one watermark drops what lags
