"""Substring dedup: words covered by a window that also starts earlier.

A window is ``window`` consecutive words. Its key is the least hash of the
``GRAM``-word sequences in it, so equal windows have equal keys wherever they
stand. Consecutive windows of one key make a segment; each window is in
exactly one.

1. One map over the texts emits a row (key, content hash, place) per segment.
2. A key seen at one place only cannot hold a repeated window; such segments
   (most of the corpus) end here, after one partial aggregate and a join.
3. Copies of a segment are grouped by content; all but the first are covered
   in full. A passage in a third of all documents is one row from here on.
4. The first copies of keys with several contents are dealt to shards by key.
   Each shard concatenates its segments in document order, builds a compressed
   FM-index (``fm_index.py``) and streams the segments through it: backward
   search gives the matching statistics up to ``window`` words, and an
   interval of that depth whose first place is earlier than the window's own
   covers its words. Equal windows have equal keys, so one shard holds them
   all, and the work is linear in the repeated text, not shards x documents.
5. A key with more than ``KEY_SEGMENTS`` different contents (the border of a
   very common passage has another one in each document) would fill a shard;
   its segments are cut into single windows and grouped by content as in 3.
6. Covered stretches go back to their documents, one join on the document.

A place is (doc_id, 64-bit hash of the text, first word); the hash is checked
to tell the texts of one id apart. Defined cases: null text
has no words; rows of one id and the same text are one document and get the
same result; rows of one id and different texts are different documents,
ordered by a hash; null ids come first; texts shorter than a window are kept
whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_of, stored, text_of
from .fm_index import FmIndex

GRAM = 8
RUN = 128  # windows in a segment at most; longer runs (repetitive text) are several
KEY_SEGMENTS = 2_000
_CHUNK = 1 << 18  # words handled at once
_NO_ID = -(1 << 63)
_M = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD1342543DE82EF95)

_SEGMENT_SQL = "key long, content long, doc long, tie long, at long"
_SEGMENT = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("at", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _windows(w: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and keys of the windows inside one document, and the hashes of the word sequences."""
    n = len(w)
    gram = min(GRAM, window)
    h = np.zeros(n, np.uint64)
    for j in range(gram):
        h[: n - j] = h[: n - j] * _M + w[j:]
    h = _mixed(h)
    least, covered, want = h, 1, window - gram + 1
    while covered < want:
        step = min(covered, want - covered)
        later = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        later[: n - step] = least[step:]
        least = np.minimum(least, later)
        covered += step
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64), h
    starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    return starts, least[starts], h


def _segments(w: np.ndarray, doc: np.ndarray, window: int, contents: bool = True):
    """(first word, windows, key, content hash, places of the key) of each segment; without the hash if it isn't wanted."""
    starts, keys, h = _windows(w, doc, window)
    if not len(starts):
        return None
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = np.flatnonzero(new)
    since = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    first = np.flatnonzero(new | (since % RUN == 0))
    many = np.diff(np.append(first, len(starts)))
    start, key = starts[first], keys[first]
    content = None
    if contents:
        powers, inverse = _powers(int(_M), len(w) + 1), _powers(_inverse(int(_M)), len(w) + 1)
        sums = np.concatenate(([0], np.cumsum(_mixed(w) * inverse[:-1], dtype=np.uint64))).astype(np.uint64)
        content = _mixed((sums[start + many + window - 1] - sums[start]) * powers[start] + many.astype(np.uint64))
    grams = many + window - min(GRAM, window)
    offsets = np.cumsum(grams) - grams
    inside = np.repeat(start - offsets, grams) + np.arange(int(grams.sum()))
    places = np.add.reduceat((h[inside] == np.repeat(key, grams)).astype(np.int64), offsets)
    return start, many, key, content, places


def _chunks(batches: Iterator[pa.RecordBatch], window: int):
    """(word hashes, number of the piece of each word, pieces as (doc, tie, first word)) in bounded chunks."""
    held: list[np.ndarray] = []
    pieces: list[tuple] = []
    size = 0

    def chunk():
        lengths = [len(x) for x in held]
        return np.concatenate(held), np.repeat(np.arange(len(held)), lengths), pieces

    for batch in batches:
        for doc, tie, text in rows_of(batch, "doc", "tie", "text"):
            words = text.encode().split()
            for at in range(0, len(words) - window + 1, _CHUNK):
                held.append(word_hashes(words[at : at + _CHUNK + window - 1]))
                pieces.append((doc, tie, at))
                size += len(held[-1])
                if size >= _CHUNK:
                    yield chunk()
                    held, pieces, size = [], [], 0
    if held:
        yield chunk()


def _emit_segments(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, piece, pieces in _chunks(batches, window):
            found = _segments(w, piece, window)
            if found is None:
                continue
            start, many, key, content, places = found
            begins = np.searchsorted(piece, np.arange(len(pieces)))
            of = piece[start]
            docs, ties, firsts = (np.array([p[k] for p in pieces], np.int64) for k in range(3))
            at = (firsts[of] + start - begins[of]) << 16 | many << 8 | np.minimum(places, 255)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(docs[of]), pa.array(ties[of]), pa.array(at)], schema=_SEGMENT)

    return run


_KEY = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def _emit_keys(window: int):
    """The key of each segment and how often it stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, piece, _ in _chunks(batches, window):
            found = _segments(w, piece, window, contents=False)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found[2].view(np.int64)), pa.array(np.minimum(found[4], 255))], schema=_KEY)

    return run


_PART = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("words", pa.binary())])
_PART_SQL = "kind int, key long, content long, doc long, tie long, start long, words binary"


def _emit_parts(window: int):
    """The words of each wanted segment (kind 0), or its windows' hashes (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _PART]
            column = batch.column(batch.schema.get_field_index("wanted"))
            flat, ends = column.flatten(), (column.offsets.to_numpy() - column.offsets[0].as_py()).tolist()
            starts, manys, keys, hots = (flat.field(c).to_numpy(zero_copy_only=False).tolist() for c in range(4))
            for row, (doc, tie, text) in enumerate(rows_of(batch, "doc", "tie", "text")):
                words = text.encode().split()
                for p in range(ends[row], ends[row + 1]):
                    start, many, key = starts[p], manys[p], keys[p]
                    mine = words[start : start + many + window - 1]
                    if not hots[p]:
                        rows = [(0, key, 0, doc, tie, start, b" ".join(mine))]
                    else:
                        w = word_hashes(mine)
                        one, two = np.zeros(many, np.uint64), np.zeros(many, np.uint64)
                        for j in range(window):
                            one, two = one * _M + w[j : j + many], two * _ODD + _mixed(w[j : j + many])
                        rows = [(1, a, b, doc, tie, start + i, None) for i, (a, b) in enumerate(zip(_mixed(one).view(np.int64).tolist(), _mixed(two).view(np.int64).tolist(), strict=True))]
                    for values in rows:
                        for into, v in zip(out, values):
                            into.append(v)
                if len(out[0]) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PART, strict=True)], schema=_PART)
                    out = [[] for _ in _PART]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PART, strict=True)], schema=_PART)

    return run


_COVER = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("many", pa.int64())])
_COVER_SQL = "doc long, tie long, start long, many long"


def _stand_twice(words: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, windows) of the runs whose windows' hashes stand
    more than once in the shard. Equal windows are all in one shard and have
    equal hashes, so no other window can be repeated."""
    flat = np.concatenate(words)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    begins = np.searchsorted(of, np.arange(len(words)))
    n = max(len(flat) - window + 1, 0)
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h = h * _M + flat[j : j + n]
    whole = np.flatnonzero(of[:n] == of[window - 1 : window - 1 + n])
    h = _mixed(h)[whole]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = whole[twice]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(of[at]) != 0)))) if len(at) else np.empty(0, np.int64)
    first = at[new]
    return of[first], first - begins[of[first]], np.diff(np.append(new, len(at)))


def repeated_windows(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, words: list[np.ndarray], window: int) -> pa.RecordBatch:
    """One shard: index its segments in document order and stream them through
    the index; the windows whose words stand at an earlier place. Stretches
    without a window that may stand twice are left out first."""
    segment, skipped, many = _stand_twice(words, window)
    if not len(segment):
        return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _COVER], schema=_COVER)
    words = [words[s][a : a + m + window - 1] for s, a, m in zip(segment.tolist(), skipped.tolist(), many.tolist(), strict=True)]
    doc, tie, start = doc[segment], tie[segment], start[segment] + skipped
    order = np.lexsort((start, tie, doc))
    lengths = np.array([len(words[i]) for i in order], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    inside = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)
    text[inside] = np.unique(np.concatenate([words[i] for i in order]), return_inverse=True)[1].reshape(-1) + 1
    index = FmIndex(text, window)
    hits_segment, hits_at = [], []
    for segment, from_end, first in index.statistics((text, begins, lengths)):
        own = begins[segment] + lengths[segment] - from_end
        again = first < own
        hits_segment.append(segment[again])
        hits_at.append(own[again] - begins[segment[again]])
    s = np.concatenate(hits_segment) if hits_segment else np.empty(0, np.int64)
    a = np.concatenate(hits_at) if hits_at else np.empty(0, np.int64)
    by = np.lexsort((a, s))
    s, a = s[by], a[by]
    new = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (a[1:] != a[:-1] + 1)))) if len(s) else np.empty(0, np.int64)
    many = np.diff(np.append(new, len(s)))
    s, a = order[s[new]], a[new]
    return pa.RecordBatch.from_arrays([pa.array(doc[s]), pa.array(tie[s]), pa.array(start[s] + a), pa.array(many)], schema=_COVER)


def _search(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def shard(rows: list[tuple]) -> pa.RecordBatch:
            doc, tie, start, many = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3, 5))
            words, ends = _numbered([r[4] for r in rows]), np.cumsum(many).tolist()
            return repeated_windows(doc, tie, start, [words[a:b] for a, b in zip([0, *ends], ends)], window)

        for batch in batches:  # sorted by key; a shard takes whole keys
            columns = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).tolist() for c in ("key", "doc", "tie", "start", "words")]
            for key, doc, tie, start, words in zip(*columns, strict=True):
                if size >= _CHUNK and key != held[-1][0]:
                    yield shard(held)
                    held, size = [], 0
                held.append((key, doc, tie, start, words, words.count(b" ") + 1))
                size += held[-1][5]
        if held:
            yield shard(held)

    return run


def _numbered(segments: list[bytes]) -> np.ndarray:
    """The words of all segments, equal numbers for equal words."""
    joined = pa.array([b" ".join(segments)], pa.large_binary())
    return pc.split_pattern(joined, " ").flatten().dictionary_encode().indices.to_numpy().astype(np.uint64)


def _place_of(id_col: str, text_col: str, seed: int = 1, doc: str = "doc", tie: str = "tie") -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias(doc), F.xxhash64(F.lit(seed), text_of(text_col)).alias(tie)]


def tie_seed(docs: DataFrame, id_col: str, text_col: str) -> int:
    """A seed whose 64-bit hash tells all texts of one id apart: it is checked
    against a second hash, and the next seed taken if two different texts share it."""
    seed = 1
    while True:
        places = docs.select(*_place_of(id_col, text_col, seed), F.xxhash64(F.lit(-seed), text_of(text_col)).alias("other"))
        seen = places.groupBy("doc", "tie").agg(F.min("other").alias("a"), F.max("other").alias("b"))
        if seen.where("a < b").isEmpty():
            return seed
        seed += 1


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, key_segments: int = KEY_SEGMENTS, seed: int | None = None) -> DataFrame:
    """(doc, tie, start, many): runs of ``many`` windows from word ``start`` on whose words also start earlier."""
    seed = tie_seed(docs, id_col, text_col) if seed is None else seed
    texts = docs.select(*_place_of(id_col, text_col, seed), text_of(text_col).alias("text"))
    # their keys are made once more for the other side of the join: cheaper than to write them
    segments = texts.mapInArrow(_emit_segments(window), _SEGMENT_SQL)
    places = texts.mapInArrow(_emit_keys(window), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # rows of one id and text stand twice: they are one document
    repeated = stored(segments.join(places.where("n > 1").select("key"), "key", "left_semi"), "repeated")
    place = F.struct("doc", "tie", "at")
    classes = stored(repeated.groupBy("key", "content").agg(F.min(place).alias("first")), "classes")
    many = F.shiftright("at", 8).bitwiseAND(F.lit(255))
    copies = repeated.join(classes, ["key", "content"]).where(place > F.col("first")).select("doc", "tie", F.shiftright("at", 16).alias("start"), many.alias("many"))

    contents = classes.groupBy("key").agg(F.count("*").alias("contents"), F.sum(F.col("first.at").bitwiseAND(F.lit(255))).alias("n")).where("n > 1")
    firsts = classes.join(contents, "key").select("key", "first.*", (F.col("contents") > key_segments).alias("hot"))
    wanted = firsts.groupBy("doc", "tie").agg(F.collect_list(F.struct(F.shiftright("at", 16).alias("start"), many.alias("many"), "key", "hot")).alias("wanted"))
    parts = stored(texts.dropDuplicates(["doc", "tie"]).join(wanted, ["doc", "tie"]).mapInArrow(_emit_parts(window), _PART_SQL), "parts")
    shards = parts.where("kind = 0").select("key", "doc", "tie", "start", "words").repartition("key").sortWithinPartitions("key")
    found = shards.mapInArrow(_search(window), _COVER_SQL)

    single = parts.where("kind = 1").select("key", "content", "doc", "tie", "start")
    at = F.struct("doc", "tie", "start")
    earliest = single.groupBy("key", "content").agg(F.min(at).alias("first"))
    cut = single.join(earliest, ["key", "content"]).where(at > F.col("first")).select("doc", "tie", "start", F.lit(1).cast("long").alias("many"))
    return copies.unionByName(found).unionByName(cut)


_KEPT = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept", pa.string())]


def _keep(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, runs in rows_of(batch, "__text", "__runs"):
                words = text.encode().split()
                counts.append(len(words))
                if runs:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [r["start"] for r in runs], 1)
                    np.add.at(edges, [r["start"] + r["many"] + window - 1 for r in runs], -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    removed.append(int(gone.sum()))
                    words = [words[i] for i in np.flatnonzero(~gone)]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            carried = [f for f in batch.schema if f.name not in ("__text", "__runs")]
            columns = [batch.column(f.name) for f in carried] + [pa.array(c, f.type) for c, f in zip((counts, removed, kept), _KEPT, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(carried + _KEPT))

    return run


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, key_segments: int = KEY_SEGMENTS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns of ``carry``, n_words, n_removed, kept) of every document."""
    from pyspark.sql.types import LongType, StringType, StructType

    seed = tie_seed(docs, id_col, text_col)
    found = covered(docs, id_col, text_col, window, key_segments, seed)
    # written, so that the shuffles before are gone when the texts are shuffled
    runs = stored(found.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "many")).alias("__runs")), "runs")
    names = [id_col, *(c for c in carry if c != id_col)]
    placed = docs.select(*names, *_place_of(id_col, text_col, seed, "__doc", "__tie"), text_of(text_col).alias("__text"))
    runs = runs.withColumnsRenamed({"doc": "__doc", "tie": "__tie"})
    joined = placed.join(runs, ["__doc", "__tie"], "left").select(*names, "__text", "__runs")
    out = StructType([joined.schema[n] for n in names]).add("n_words", LongType()).add("n_removed", LongType()).add("kept", StringType())
    return joined.mapInArrow(_keep(window), out)
