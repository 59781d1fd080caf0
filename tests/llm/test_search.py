"""Both searches against brute force."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from millrun.llm import hamming, inverted_index  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"


def _nearest(rows, queries, k):
    out = []
    for qid, q in set(queries):
        others = sorted({((q ^ c) & (1 << 64) - 1).bit_count() * (1 << 40) + i for i, c in rows if i != qid})[:k]
        out += [(qid, n + 1, x & (1 << 40) - 1, x >> 40) for n, x in enumerate(others)]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "clusters", "one code", "few"])
def test_hamming_top_k_against_all(spark, case):
    rnd = random.Random(case)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    code = lambda: rnd.getrandbits(64)
    if case == "random":
        rows = [(i, signed(code())) for i in range(400)]
    elif case == "clusters":
        centres = [code() for _ in range(5)]
        rows = [(i, signed(rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))))) for i in range(300)]
    elif case == "one code":
        same = signed(code())
        rows = [(i, same) for i in range(200)] + [(200 + i, signed(code())) for i in range(60)]
    else:
        rows = [(i, signed(code())) for i in range(4)]
    rows += rows[:3]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(None, 5, "x"), (999, None, "x")], "vec_id long, code long, distance string").repartition(3)
    got = hamming.top_k(df, df.where("vec_id % 20 = 0"), k=10)
    assert sorted(map(tuple, got.collect())) == _nearest(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert hamming.top_k(df.where("false"), df.where("false")).count() == 0


def test_sign_codes(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, [1.0, -1.0, 0.0, 2.0], 0), (2, None, 0), (3, [], 0), (4, [1.0, None], 0), (5, [nan], 0), (6, [-inf, 1.0], 0), (7, [1.0] * 70, 0)], VECTORS)
    got = {r.vec_id: r.c for r in df.select("vec_id", hamming.sign_code("embedding").alias("c")).collect()}
    assert got == {1: 0b1001, 2: None, 3: None, 4: None, 5: None, 6: None, 7: -1}


def _vectors(n, seed, scale=False):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, 16))
    x = centres[rnd.integers(0, 12, n)] + 0.6 * rnd.normal(size=(n, 16))
    return (x * rnd.uniform(0.2, 3, (n, 1)) if scale else x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def _exact(ids, x, qid, q, k):
    x = x.astype(float)
    s = (x * q.astype(float)).sum(1)
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != qid][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


@pytest.mark.parametrize("scale", [False, True])
def test_inverted_index_recall_and_scores(spark, scale):
    x = _vectors(3_000, 1, scale)
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], VECTORS).repartition(4)
    got = inverted_index.search(df, df.where("vec_id % 20 = 0"), k=20, least=100).collect()
    found: dict = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for qid in range(0, len(x), 20):
        mine = sorted(found[qid])
        assert [m[0] for m in mine] == list(range(1, 21)) and all(m[1] != qid for m in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        exact = _exact(ids, x, qid, x[qid], 20)
        scores = dict(_exact(ids, x, qid, x[qid], len(x)))
        assert all(abs(scores[m[1]] - m[2]) < 1e-12 * max(1, abs(m[2])) for m in mine)
        hits += len({m[1] for m in mine} & {i for i, _ in exact})
    assert hits / (20 * len(found)) >= 0.9


def test_inverted_index_is_exact_on_a_small_table_with_awkward_rows(spark, monkeypatch):
    x = _vectors(300, 2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(400 + i, x[0].tolist(), 0) for i in range(150)] + rows[:5]  # one very common vector, repeated rows
    bad = [(600, None, 0), (601, [], 0), (602, [0.0] * 16, 0), (603, [nan] * 16, 0), (604, [inf] + [1.0] * 15, 0), (605, [None] + [1.0] * 15, 0), (606, [1.0, 2.0], 0), (None, x[1].tolist(), 0)]
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(3)
    for block in (32, 1_024):  # cells of several blocks, and several cells a block
        monkeypatch.setattr(inverted_index, "BLOCK_ROWS", block)
        got = inverted_index.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
        ids = np.array(sorted({r[0] for r in rows}))
        whole = np.array([dict((r[0], r[1]) for r in rows)[i] for i in ids], np.float32)
        want = []
        for qid in [i for i in ids if i % 20 == 0]:
            want += [(int(qid), n + 1, i) for n, (i, _) in enumerate(_exact(ids, whole, qid, whole[list(ids).index(qid)], 20))]
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(want)
    assert inverted_index.search(df.where("false"), df.where("false")).count() == 0
    assert inverted_index.search(df, df.where("false")).count() == 0
