"""SimHash, the trie join, the FM-index and substring dedup against brute force."""

from __future__ import annotations

import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, docs, table  # noqa: E402

from millrun.llm import simhash, substrings  # noqa: E402
from millrun.llm.fm_index import FmIndex  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fps, distance=3):
    """Label of each fingerprint's component, by all pairs."""
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_by_the_letter():
    for text in [t for _, t in awkward()] + ["A b C", "Ä Ö Ü ẞ", "x " * 50, "a b"]:
        assert simhash.fingerprint(text or "") == _fingerprint(text)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_trie_join_against_all_pairs(seed):
    rnd = random.Random(seed)
    groups, fps = [], []
    for g in range(6):
        centres = [rnd.getrandbits(64) for _ in range(4)]
        own = set()
        for _ in range(60):
            fp = rnd.choice(centres)
            for _ in range(rnd.choice((0, 1, 2, 3, 6))):
                fp ^= 1 << rnd.randrange(64)
            own.add(fp)
        fps += sorted(own)
        groups += [g] * len(own)
    got = simhash.trie_components(np.array(groups), np.array(fps, np.uint64), 3)
    for g in range(6):
        at = [i for i, x in enumerate(groups) if x == g]
        assert [got[i] - at[0] for i in at] == _classes([fps[i] for i in at])
    assert len(simhash.trie_components(np.array([], int), np.array([], np.uint64), 3)) == 0


def test_hot_groups_are_split_without_loss(spark):
    """All fingerprints share most bits: every group is larger than allowed, at each level."""
    rnd = random.Random(4)
    base = rnd.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rnd.sample(range(0, 64, 2), rnd.choice((0, 1, 4, 7)))) for _ in range(400)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    nodes = {r.node: r.root for r in simhash.components(simhash.links(df, 3, group_rows=20)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = _classes(fps)
    roots = [nodes.get(f, f) for f in signed]
    assert len(set(classes)) == len(set(roots)) and len(set(zip(classes, roots, strict=True))) == len(set(roots))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    random.Random(0).shuffle(edges)
    got = dict(table(simhash.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(1, 41)}, **{1000 + i: 1000 for i in range(1, 50)}}


def _variants(seed=1):
    rnd = random.Random(seed)
    rows = [(r[0], r[1]) for r in awkward() if r[0] is not None]
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rnd.choice(vocabulary) for _ in range(400)]
    for i in range(40):
        words = list(base)
        for _ in range(i % 4):
            words[rnd.randrange(400)] = rnd.choice(vocabulary)
        rows.append((200 + i, " ".join(words)))
    return rows


def test_near_duplicates_against_all_pairs(spark):
    rows = _variants()
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(spark, rows, clash=True)).collect()}
    fps = [_fingerprint(t) for _, t in rows]
    classes = _classes(fps)
    least = {c: min(rows[i][0] for i in range(len(rows)) if classes[i] == c) for c in classes}
    assert got == {(rows[i][0], f"{fps[i]:016x}", least[classes[i]]) for i in range(len(rows))}
    assert simhash.near_duplicates(docs(spark, rows).where("false")).count() == 0


def test_keep_one(spark):
    rows = [*_variants(), (None, "an id that is missing has a text of its own"), (None, "and another one with other words in it")]
    df = docs(spark, rows, clash=True)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    fps = [_fingerprint(t) for _, t in rows]
    assert kept.count() == len(set(_classes(fps)))
    assert sorted(r.text for r in kept.where("doc_id is null").collect()) == sorted(t for d, t in rows if d is None)


def test_fm_index_statistics_against_search():
    rnd = np.random.default_rng(2)
    for depth in (2, 3, 5, 20):
        for alphabet in (1, 2, 6, 40):
            parts = [rnd.integers(1, alphabet + 1, int(rnd.integers(1, 60))) for _ in range(12)]
            text = np.concatenate([np.append(p, 0) for p in parts])
            patterns = [rnd.integers(1, alphabet + 1, int(rnd.integers(1, 50))) for _ in range(10)] + [p[: len(p) // 2 + 1] for p in parts]
            patterns = [np.minimum(p, text.max()) for p in patterns]
            symbols = np.concatenate(patterns)
            lengths = np.array([len(p) for p in patterns])
            starts = np.cumsum(lengths) - lengths
            index = FmIndex(text, depth)
            got = {(int(p), int(lengths[p]) - at): int(f) for which, at, first in index.statistics((symbols, starts, lengths)) for p, f in zip(which, first, strict=True)}
            want = {}
            places = {}
            for i in range(len(text) - depth, -1, -1):
                if 0 not in text[i : i + depth]:
                    places[tuple(text[i : i + depth])] = i
            for p, pattern in enumerate(patterns):
                for i in range(len(pattern) - depth + 1):
                    if (first := places.get(tuple(pattern[i : i + depth]))) is not None:
                        want[p, i] = first
            assert got == want


def _deduplicated(rows, window):
    """(doc_id, n_words, n_removed, kept) by a table of all windows; rows of one id and text are one document."""
    def place(r):
        return (r[0] is not None, r[0] or 0, r[2])

    seen, out = {}, {}
    for r in sorted(set(rows), key=place):
        words = WORD.findall(r[1] or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.setdefault(w, r)
        out[r] = (r[0], len(words), sum(gone), " ".join(x for x, g in zip(words, gone, strict=True) if not g))
    return sorted((out[r] for r in rows), key=repr)


def _passages(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    shared, common = [text(rnd.randrange(15, 60)) for _ in range(4)], text(35)
    rows = list(awkward())
    for i in range(60):
        parts = [text(rnd.randrange(0, 40)), rnd.choice(shared), text(rnd.randrange(0, 30))]
        if i % 2:
            parts.insert(rnd.randrange(4), common)
        rows.append((300 + i, "\n".join(parts)))
    return rows + [(500, "ab cd " * 200), (501, "x ab cd " + "ab cd " * 90), (502, "z " * 400)]


@pytest.mark.parametrize(("window", "key_segments"), [(20, 2_000), (20, 3), (7, 2_000), (7, 1)])
def test_substring_dedup_against_a_table_of_windows(spark, window, key_segments):
    rows = _passages(window)
    df = docs(spark, rows, clash=True)
    tied = {(r.doc_id, r.text): r.t for r in df.select("doc_id", "text", F.hash(F.coalesce("text", F.lit(""))).alias("t")).collect()}
    got = substrings.deduplicate(df, window=window, key_segments=key_segments, carry=tuple(df.columns))
    assert got.columns == [*df.columns, "n_words", "n_removed", "kept"]
    assert table(got, "doc_id", "n_words", "n_removed", "kept") == _deduplicated([(d, t, tied[d, t]) for d, t in rows], window)
    assert got.select("doc", "tie", "key").distinct().count() == 1


def test_substring_dedup_across_chunks(spark, monkeypatch):
    rows = _passages(3)
    df = docs(spark, rows)
    tied = {(r.doc_id, r.text): r.t for r in df.select("doc_id", "text", F.hash(F.coalesce("text", F.lit(""))).alias("t")).collect()}
    want = _deduplicated([(d, t, tied[d, t]) for d, t in rows], 20)
    texts = df.select(*substrings._place_of("doc_id", "text"), F.coalesce("text", F.lit("")).alias("text"))
    for chunk in (64, 1 << 18):  # cut within documents, or not at all: the windows are the same
        monkeypatch.setattr(substrings, "_CHUNK", chunk)
        batches = texts.coalesce(1).toArrow().to_batches()
        windows = sum(int(r["at"] >> 8 & 255) for b in substrings._emit_segments(20)(iter(batches)) for r in b.to_pylist())
        assert windows == sum(max(0, w[1] - 19) for w in want)
    assert substrings.deduplicate(df.where("false")).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    """Two texts with one 32-bit hash stand under one id; only one of them is a copy."""
    from pyspark.sql import functions as F

    tail = " ".join(f"word{i}" for i in range(25))
    texts = spark.range(300_000).select("id", F.concat(F.lit("start"), "id", F.lit(" " + tail.replace("word", "own")), F.lit(" end"), "id").alias("text"))
    clash = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).first().t
    x = clash[0]
    by_hash = spark.createDataFrame([(x,), (clash[1],)], "text string").select(F.hash("text")).distinct().count()
    assert by_hash == 1
    rows = [(1, x), (5, x), (5, clash[1].replace("end", "other")), (5, clash[1])]
    # a window of all 27 words: only the copy under id 5 is repeated
    got = sorted((r.doc_id, r.kept == "", r.n_removed) for r in substrings.deduplicate(docs(spark, rows), window=27).collect())
    assert got == [(1, False, 0), (5, False, 0), (5, False, 0), (5, True, 27)]


def test_a_seed_that_confuses_texts_is_not_taken(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = substrings._place_of
    monkeypatch.setattr(substrings, "_place_of", lambda i, t, seed, *n: [real(i, t, seed, *n)[0], (real(i, t, seed, *n)[1] if seed > 2 else F.lit(7).cast("long")).alias(n[1] if n else "tie")])
    assert substrings.tie_seed(docs(spark, [(1, "a"), (1, "b"), (2, "a")]), "doc_id", "text") == 3
    assert substrings.tie_seed(docs(spark, [(1, "a"), (1, "a"), (2, "b")]), "doc_id", "text") == 1


def test_only_windows_that_stand_twice_reach_the_index():
    rnd = random.Random(4)
    words = [np.array([rnd.randrange(6) for _ in range(rnd.randrange(3, 30))], np.uint64) for _ in range(40)]
    got = {(s, a + i) for s, a, m in zip(*(x.tolist() for x in substrings._stand_twice(words, 3)), strict=True) for i in range(m)}
    seen: dict = {}
    for s, w in enumerate(words):
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i : i + 3].tolist()), []).append((s, i))
    assert got == {p for places in seen.values() if len(places) > 1 for p in places}
    assert all(not len(x) for x in substrings._stand_twice([np.arange(2, dtype=np.uint64)], 3))


def test_words_of_a_shard_are_numbered_without_hashes():
    """Equal words have equal numbers, different words different ones, whatever their hashes."""
    segments = ["the cat sat".encode(), "é the".encode(), b"cat", "sat \x00 the cat 漢".encode()]
    words = [w for s in segments for w in s.split(b" ")]
    got = substrings._numbered(segments).tolist()
    assert len(got) == len(words) and dict(zip(words, got)) == {w: n for w, n in zip(words, got)}
    assert [[a == b for b in got] for a in got] == [[a == b for b in words] for a in words]
