"""Decontamination, centroid clustering and hard negatives against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, docs, table  # noqa: E402

from millrun.llm import centroids, decontamination, hard_negatives  # noqa: E402

ITEM = "item_id long, text string, start string, words string"
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _windows(items, size):
    out = {}
    for item, text in items:
        words = _words(text)
        for at in range(max(len(words) - size, 0) + 1 if words else 0):
            out.setdefault(tuple(words[at : at + size]), set()).add(item)
    return out


def _listed(items):
    names = sorted({str(i) for i in items if i is not None})
    return len(names), hashlib.sha256(",".join(names).encode()).hexdigest()


def _exact(rows, items, size):
    windows = _windows(items, size)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words, hit, found = _words(text), set(), set()
        for n in sizes:
            for at in range(len(words) - n + 1):
                if of := windows.get(tuple(words[at : at + n])):
                    hit.update(range(at, at + n))
                    found |= of
        out.append((doc, len(words), len(hit), *_listed(found), bool(hit)))
    return sorted(out, key=repr)


def _near(rows, items, size, span):
    windows = _windows(items, size)
    out = []
    for doc, text in rows:
        words = _words(text)
        stretches = [set(words[at : at + span]) for at in range(max(len(words) - span, 0) + 1)]
        found = {i for w, of in windows.items() if any(set(w) <= s for s in stretches) for i in of}
        out.append((doc, len(words), *_listed(found)))
    return sorted(out, key=repr)


def _cases(seed):
    rnd = random.Random(seed)
    vocabulary = ["The", "of", "AND", "naïve", "Ñandú", "x1", "漢字", "word's", "blue", "re-do", "İx", "ça"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(20, None), (21, ""), (22, " ?! "), (23, "blue"), (24, items[4][1]), (None, items[5][1]), (10, items[10][1]), (25, "absent terms that no text has at all in any of these rows"), (26, "of of of of of of of of of of of of")]
    rows = [(d, t) for d, t, *_ in awkward()]
    for d in range(100, 140):
        item = rnd.choice(items)[1] or ""
        rows.append((d, f"{text(rnd.randrange(30))} {item.upper() if item.isascii() else item}, {text(5)}"))
    shuffled = (items[3][1] or "").split()
    rnd.shuffle(shuffled)
    rows += [(200, " ".join(shuffled)), (201, items[4][1].replace(" ", "\n--")), (201, items[4][1]), (None, items[5][1]), (202, "of " * 40)]
    rows += [(300 + i, "a very common passage stands here in many of the texts again") for i in range(60)]
    items.append((30, "very common passage stands here in many of the texts again and ends"))
    return rows, items


@pytest.mark.parametrize(("size", "ratio", "slot"), [(10, 8, 50_000), (4, 1, 7)])
def test_phrases_and_proximity_against_all_windows(spark, monkeypatch, size, ratio, slot):
    monkeypatch.setattr(decontamination, "LIST_RATIO", ratio)
    monkeypatch.setattr(decontamination, "SLOT_ROWS", slot)
    rows, items = _cases(size)
    df = docs(spark, rows, clash=True)
    tests = spark.createDataFrame([(*i, "s", "w") for i in items], ITEM).repartition(2)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = decontamination.decontaminate(df, tests, size)
    assert got.columns == columns and table(got, *columns) == _exact(rows, items, size)
    near = decontamination.decontaminate_near(df, tests, size, span=12)
    assert table(near, *near.columns) == _near(rows, items, size, 12)


def test_terms_above_the_broadcast_bound_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "TERMS_MAX_ROWS", 1)
    rows, items = _cases(3)
    got = decontamination.decontaminate(docs(spark, rows), spark.createDataFrame([(*i, "s", "w") for i in items], ITEM), 10)
    assert table(got, *got.columns) == _exact(rows, items, 10)


def test_decontamination_of_empty_tables(spark):
    one, none = docs(spark, [(1, "some words")]), docs(spark, [])
    item, nothing = spark.createDataFrame([(1, "some words", "", "")], ITEM), spark.createDataFrame([], ITEM)
    assert decontamination.decontaminate(none, item).count() == 0
    assert table(decontamination.decontaminate(one, nothing), "n_hit", "contaminated") == [(0, False)]
    assert table(decontamination.decontaminate_near(one, nothing), "n_items") == [(0,)]
    assert table(decontamination.decontaminate(one, item), "n_hit", "n_items") == [(2, 1)]


def test_decontamination_needs_no_python(spark):
    rows, items = _cases(1)
    index = decontamination.build_index(docs(spark, rows), spark.createDataFrame([(*i, "s", "w") for i in items], ITEM))
    for df in (decontamination.phrase_matches(index), decontamination.near_matches(index), index.postings, index.texts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|InPandas|InArrow|Cartesian|NestedLoop", plan)


VECTORS = "vec_id long, embedding array<float>, label int, id string, v string"


def _embeddings(n, seed, size=16, scale=0.2):
    rnd = np.random.default_rng(seed)
    rows = [(i, (scale * rnd.normal(size=size)).astype(np.float32).tolist(), int(rnd.integers(0, 3))) for i in range(n)]
    same = [0.125] * size  # a third of the rows are one vector
    rows += [(1_000 + i, same, i % 2) for i in range(n // 2)] + rows[:7]
    rows += [(i + 2_000, [(-1) ** i * 1000.0 / (i + 1)] * size, 1) for i in range(5)]
    nan, inf = float("nan"), float("inf")
    bad = [(3_000, None, 1), (3_001, [], 1), (3_002, [nan] * size, 1), (3_003, [inf] + [0.0] * (size - 1), 1), (3_004, [None] * size, 1), (3_005, [1e30] * size, 1), (3_006, [1.0, 2.0], 2)]
    return rows, bad


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)


def _whole(v, scale):
    return np.floor(np.asarray(v, np.float64) * scale).astype(np.int64)


def _lloyd(rows, k, rounds, scale):
    x = np.array([_whole(v, scale) for _, v, _ in rows])
    names = [hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest() for i, _, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (names[i], x[i].tolist()))[:k]
    c = x[order].copy()
    for n in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        nearest = d.argmin(axis=1)
        for j in range(len(c) if n < rounds else 0):
            if (nearest == j).any():
                c[j] = [int(s) // int((nearest == j).sum()) for s in x[nearest == j].sum(axis=0)]
    best = d[np.arange(len(x)), nearest]
    shas = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    return sorted(
        ((r[0], int(j), int(b), int(best[nearest == j].sum()), int(best.sum()), shas[j]) for r, j, b in zip(rows, nearest, best, strict=True)),
        key=repr,
    )


@pytest.mark.parametrize("block", [16, 4_096])
def test_clusters_against_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", block)
    rows, bad = _embeddings(150, 1)
    rows.append((None, rows[0][1], 0))
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for k, rounds in ((8, 10), (3, 0)):
        got = centroids.with_inertia(*centroids.cluster(_frame(spark, rows + bad), k, rounds, size=16))
        assert got.columns == columns and table(got, *columns) == _lloyd(rows, k, rounds, 1024)
    few = rows[:3]
    assert table(centroids.with_inertia(*centroids.cluster(_frame(spark, few), size=16)), *columns) == _lloyd(few, 8, 10, 1024)
    empty = centroids.with_inertia(*centroids.cluster(_frame(spark, bad), size=16))
    assert empty.columns == columns and empty.count() == 0


def _mined(rows, every, low, high):
    kept = sorted({(i, label, tuple(_whole(v, 256).tolist())) for i, v, label in rows})
    out = []
    for a in kept:
        if a[0] % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in kept if r != a and len(r[2]) == len(a[2])]
        for score, positive, _ in sorted(s for s in scored if s[2] == a[1])[:5]:
            fit = sorted(s for s in scored if s[2] != a[1] and low * -score <= -100 * s[0] <= high * -score)[:5]
            out += [(a[0], positive, n + 1, s[1], -score, -s[0]) for n, s in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize(("size", "per", "anchors", "low"), [(16, 2_048, 1_024, 80), (16, 20, 3, 80), (4, 16, 2, 97), (2, 2_048, 5, 50)])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, size, per, anchors, low):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", per)
    monkeypatch.setattr(hard_negatives, "GROUP_BUCKETS", 2)
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", anchors)
    rows, bad = _embeddings(200, size, size)
    rows.append((4_000, [0.0] * size, 1))  # no length; every score is zero
    bad = [b for b in bad if b[1] != []] + [(None, rows[0][1], 0), (4_010, rows[1][1], None)]
    if size == 2:  # [1.0, 2.0] is of that size, and a row like any other
        rows += [b for b in bad if b[0] == 3_006]
    given = hard_negatives.integer_rows(_frame(spark, rows + bad), 256)
    got = hard_negatives.mine(given, given.where("id % 20 = 0"), low=low)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == _mined(rows, 20, low, 100)
    assert hard_negatives.mine(given.where("false"), given.where("false")).count() == 0


def test_coordinate_ranges_prune_and_lose_nothing():
    rnd = np.random.default_rng(3)
    x = rnd.integers(-40, 40, (2_000, 6))
    x[::3] *= 9
    row = hard_negatives.bucket(np.arange(2_000), np.zeros(2_000, np.int64), x)
    found = hard_negatives._Bucket({c: row.column(i)[0].as_py() for i, c in enumerate(row.schema.names)})
    kept = 0
    for i in range(0, 2_000, 50):
        anchor = hard_negatives._Anchor(0, i, 0, x[i], [])
        scores = x @ x[i]
        bar = int(np.sort(scores)[-6])
        rows = found.candidates(anchor, bar)
        rows = np.arange(2_000) if rows is None else rows
        assert set(np.flatnonzero(scores >= bar)) <= set(rows.tolist())
        kept += len(rows)
    assert kept < 0.5 * 40 * 2_000  # lengths differ by nine here, which a bucket never holds
