"""Hard-negative mining by coordinate pruning over length buckets.

Rows are integer vectors with a label. An anchor's positives are its nearest
rows of its own label by inner product; a positive's hard negatives are the
nearest rows of other labels whose score lies between two shares of its own.

1. Index. Rows are sorted by length (classes a tenth apart, longest first) and
   label and cut into buckets of at most ``BUCKET_ROWS`` rows of one class. A
   bucket keeps its longest length, and per coordinate the list of its rows
   sorted by that coordinate of their unit vector. It is written once.
2. Search. A task holds a chunk of anchors and streams the buckets of a group,
   longest first. With a score to beat, t = score / (anchor length * longest
   length) bounds the cosine: above 1 the bucket is left out; else, on each of
   the anchor's ``FOCUS`` largest coordinates, a row's coordinate must lie in
   a range about t times the anchor's, found by bisection in the sorted
   list. Rows in all ranges are verified exactly. The score to beat rises as
   better rows are found, so later buckets are pruned harder.
3. What a group gives (at most ``positives``, or ``negatives`` for each
   positive score) is ranked over all groups.

Both searches run so: first for positives, then for negatives, which start with
the lowest score that any of the anchor's positives admits.

Memory of a task: one chunk of anchors with their best rows, one bucket. Hot
labels and repeated vectors are cut into buckets like any others.

Defined cases: rows with a null id, label or vector, with null or non-finite
components, or with a component whose integer is ``LIMIT`` or more take no
part; rows equal in id, label and vector are one row; vectors of different
sizes are not compared; ties go to the smaller id; a positive score below zero
has no negatives; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUCKET_ROWS = 2_048
GROUP_BUCKETS = 8
CHUNK_ANCHORS = 1_024
FOCUS = 5
LIMIT = 1 << 24
_STEP = 0.9  # lengths in a bucket differ by this factor at most
_SLACK = 1e-5  # the lists are single precision

_BUCKET = pa.schema(
    [("size", pa.int32()), ("longest", pa.float64()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("places", pa.binary()), ("coords", pa.binary())]
)
_BUCKET_SQL = "size int, longest double, ids binary, labels binary, vectors binary, places binary, coords binary"
_FOUND = pa.schema([("anchor", pa.int64()), ("bar", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor long, bar long, id long, score long"


def integer_rows(rows: DataFrame, scale: int, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(id, label, v) of the rows that take part; components become floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    fit = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float(LIMIT // scale)))
    good = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fit, F.lit(False))
    v = F.transform(x, lambda e: F.floor(e * float(scale)).cast("int"))
    return rows.where(good).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v")).distinct()


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def bucket(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """One bucket with its sorted coordinate lists."""
    x = x.astype(np.float64)
    length = np.sqrt((x * x).sum(axis=1))
    unit = (x / np.maximum(length, 1e-300)[:, None]).astype(np.float32).T
    places = np.argsort(unit, axis=1, kind="stable")
    coords = np.take_along_axis(unit, places, axis=1)
    blobs = [ids.astype("<i8"), labels.astype("<i8"), x.astype("<i4"), places.astype("<u2"), coords.astype("<f4")]
    values = [[x.shape[1]], [float(length.max())], *[[np.ascontiguousarray(b).tobytes()] for b in blobs]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _BUCKET, strict=True)], schema=_BUCKET)


def _to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (class, size, ...) into buckets of one class and size."""
    here, held, parts = None, 0, []

    def done() -> pa.RecordBatch:
        return bucket(*(np.concatenate(c) for c in zip(*parts, strict=True)))

    for batch in batches:
        if not batch.num_rows:
            continue
        kind, size = (batch.column(c).to_numpy() for c in (3, 4))
        cuts = np.flatnonzero((np.diff(kind) != 0) | (np.diff(size) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kind)], strict=True):
            if (kind[a], size[a]) != here and parts:
                yield done()
                held, parts = 0, []
            here = (kind[a], size[a])
            while a < b:
                take = min(b - a, BUCKET_ROWS - held)
                run = batch.slice(a, take)
                parts.append((run.column(0).to_numpy(), run.column(1).to_numpy(), _matrix(run.column(2), int(size[a]))))
                a, held = a + take, held + take
                if held == BUCKET_ROWS:
                    yield done()
                    held, parts = 0, []
    if parts:
        yield done()


def build_index(rows: DataFrame) -> DataFrame:
    """The buckets of (id, label, v) rows, written once."""
    square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    kind = F.when(square > 0, F.floor(F.log(square) / (2 * float(-np.log(_STEP))))).otherwise(-1).cast("int")
    classed = rows.select("id", "label", "v", kind.alias("kind"), F.size("v").alias("size"))
    order = [F.desc("kind"), "size", "label", F.xxhash64("id"), "id"]
    dealt = classed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(_to_buckets, _BUCKET_SQL), "buckets")


class _Bucket:
    def __init__(self, row: dict) -> None:
        n = len(row["ids"]) // 8
        self.size, self.longest = row["size"], row["longest"]
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.x = np.frombuffer(row["vectors"], "<i4").reshape(n, self.size).astype(np.int64)
        self.places = np.frombuffer(row["places"], "<u2").reshape(self.size, n)
        self.coords = np.frombuffer(row["coords"], "<f4").reshape(self.size, n)
        self.largest = int(np.abs(self.x).max(initial=0))
        self.floats = self.x.astype(np.float64)

    def candidates(self, anchor: _Anchor, bar: int | None) -> np.ndarray | None:
        """Rows that may score ``bar`` or more; None: any of them."""
        if bar is None or bar <= 0 or not self.size:
            return None
        reach = anchor.length * self.longest
        t = bar / reach if reach else 2.0
        if t > 1 + _SLACK:
            return np.empty(0, np.int64)
        t = min(t, 1.0)
        spread = np.sqrt(np.maximum((1 - anchor.top**2) * (1 - t * t), 0)) + _SLACK
        ranges = []
        for f, low, high in zip(anchor.focus, anchor.top * t - spread, anchor.top * t + spread, strict=True):
            # a cosine above t allows a coordinate up to the anchor's own and beyond t times it
            if anchor.unit[f] >= t:
                high = 1.0
            if -anchor.unit[f] >= t:
                low = -1.0
            a, b = np.searchsorted(self.coords[f], [low - _SLACK, high + _SLACK])
            ranges.append((b - a, f, a, b))
        ranges.sort()
        many, f, a, b = ranges[0]
        if many > 0.9 * len(self.ids):
            return None
        found = self.places[f, a:b]
        for many, f, a, b in ranges[1:]:
            if many > 0.9 * len(self.ids):
                break
            inside = np.zeros(len(self.ids), bool)
            inside[self.places[f, a:b]] = True
            found = found[inside[found]]
        return found.astype(np.int64)

    def scores(self, anchor: _Anchor, rows: np.ndarray) -> np.ndarray:
        """Exact inner products: doubles while every partial sum is an exact integer, else integers."""
        if self.size * self.largest * anchor.largest < 1 << 53:
            return (self.floats[rows] @ anchor.floats).astype(np.int64)
        return (self.x[rows] * anchor.x).sum(axis=1)


class _Anchor:
    def __init__(self, number: int, own: int, label: int, v: np.ndarray, bars: list[tuple[int, int, int]]) -> None:
        """``bars``: (name, least, most) score of each list of best rows."""
        self.number, self.own, self.label = number, own, label
        self.x, self.floats, self.largest = v, v.astype(np.float64), int(np.abs(v).max(initial=0))
        self.length = float(np.sqrt((self.floats**2).sum()))
        self.unit = self.floats / max(self.length, 1e-300)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]
        self.top = self.unit[self.focus]
        self.bars = bars
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in bars]

    def to_beat(self, k: int) -> int | None:
        """The least score that can still change a list."""
        lowest = None
        for (_, least, _), (score, _) in zip(self.bars, self.best, strict=True):
            need = max(least, int(score[-1])) if len(score) == k else least
            lowest = need if lowest is None else min(lowest, need)
        return lowest

    def take(self, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
        for n, (_, least, most) in enumerate(self.bars):
            had, had_ids = self.best[n]
            floor = max(least, int(had[-1])) if len(had) == k else least
            fit = (scores >= floor) & (scores <= most)
            if fit.any():
                score, all_ids = np.concatenate([had, scores[fit]]), np.concatenate([had_ids, ids[fit]])
                order = np.lexsort((all_ids, -score))[:k]
                self.best[n] = score[order], all_ids[order]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for (name, _, _), (score, ids) in zip(self.bars, self.best, strict=True):
            for s, i in zip(score.tolist(), ids.tolist(), strict=True):
                yield self.number, name, i, s


_LEAST, _MOST = -(1 << 62), 1 << 62


def search_bucket(found: _Bucket, anchors: list[_Anchor], same: bool, k: int) -> None:
    """Let each anchor take what the bucket has for it: rows of its label, or of others."""
    labels = set(np.unique(found.labels).tolist())
    of_label = {label: np.flatnonzero(found.labels == label) if same else np.flatnonzero(found.labels != label) for label in {a.label for a in anchors} if not same or label in labels}
    for anchor in anchors:
        mine = of_label.get(anchor.label)
        if mine is None or not len(mine):
            continue
        rows = found.candidates(anchor, anchor.to_beat(k))
        if rows is None:
            rows = mine
        else:
            rows = rows[(found.labels[rows] == anchor.label) == same]
        if not len(rows):
            continue
        if same:  # not the anchor itself
            own = rows[found.ids[rows] == anchor.own]
            if len(own):
                rows = rows[~np.isin(rows, own[(found.x[own] == anchor.x).all(axis=1)])]
        anchor.take(found.ids[rows], found.scores(anchor, rows), k)


def _search(same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, anchors = None, {}

        def done() -> pa.RecordBatch:
            rows = [r for a in anchors.values() for x in a for r in x.rows()]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(_FOUND)], schema=_FOUND)

        for batch in batches:
            names = batch.schema.names
            for n in range(batch.num_rows):
                row = {c: batch.column(i)[n] for i, c in enumerate(names)}
                cell = (row["group"].as_py(), row["chunk"].as_py())
                if cell != here:
                    if anchors:
                        yield done()
                    here, anchors = cell, {}
                if not row["bucket"].as_py():
                    v = np.array(row["v"].as_py(), np.int64)
                    bars = [tuple(b.values()) for b in row["bars"].as_py()]
                    anchors.setdefault(len(v), []).append(_Anchor(row["anchor"].as_py(), row["id"].as_py(), row["label"].as_py(), v, bars))
                elif row["size"].as_py() in anchors:
                    found = _Bucket({c: row[c].as_py() for c in _BUCKET.names})
                    search_bucket(found, anchors[found.size], same, k)
        if anchors:
            yield done()

    return run


def _best(index: DataFrame, anchors: DataFrame, groups: int, chunks: int, same: bool, k: int) -> DataFrame:
    """(anchor, bar, id, score, rank): the k best rows of each list of each anchor.
    A cell is (group of buckets, chunk of anchors): anchors go to every group, buckets to every chunk."""
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in index.schema}
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int").alias("chunk"),
        F.lit(False).alias("bucket"), "anchor", "id", "label", "v", "bars", *nothing.values(),
    )
    empty = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in ("anchor", "id", "label", "v", "bars")]
    held = index.select(
        F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        F.lit(True).alias("bucket"), *empty, *nothing.keys(),
    )
    cells = asked.unionByName(held).repartition("group", "chunk").sortWithinPartitions("group", "chunk", "bucket", F.desc("longest"))
    found = cells.mapInArrow(_search(same, k), _FOUND_SQL)
    rank = F.row_number().over(Window.partitionBy("anchor", "bar").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _bar(name, least, most):
    return F.struct(F.lit(name).cast("long").alias("name") if isinstance(name, int) else name.alias("name"), F.lit(least).cast("long").alias("least") if isinstance(least, int) else least.alias("least"), F.lit(most).cast("long").alias("most") if isinstance(most, int) else most.alias("most"))


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, base: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (id, label, v) rows:
    the hard negatives of each positive of each anchor, with
    ``low * positive_score <= base * negative_score <= high * positive_score``."""
    index = build_index(rows)
    asked = stored(anchors.select("id", "label", "v").distinct().withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    groups = max(1, -(-index.count() // GROUP_BUCKETS))
    chunks = max(1, -(-asked.count() // CHUNK_ANCHORS))
    any_score = asked.withColumn("bars", F.array(_bar(0, _LEAST, _MOST)))
    near = stored(_best(index, any_score, groups, chunks, True, positives), "positives")
    score = F.col("score")
    # whole numbers: the least and the greatest negative score that a positive admits
    admitted = _bar(score, F.ceil(score * low / F.lit(base).cast("decimal(20,0)")).cast("long"), F.floor(score * high / F.lit(base).cast("decimal(20,0)")).cast("long"))
    bars = near.where("score >= 0").groupBy("anchor").agg(F.collect_set(admitted).alias("bars"))  # at most ``positives`` each
    hard = _best(index, asked.join(bars, "anchor"), groups, chunks, False, negatives)
    left = near.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor").select("anchor", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    right = hard.select("anchor", F.col("bar").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return left.join(right, ["anchor", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
    WITH kept AS MATERIALIZED (
        SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS MATERIALIZED (
        SELECT a.id AS anchor_id, a.label AS mine, c.label, c.id,
               CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
        FROM kept a JOIN kept c ON len(a.v) = len(c.v) AND (a.id <> c.id OR a.label <> c.label OR a.v <> c.v)
        WHERE a.id % 100 = 0),
    positives AS (
        SELECT anchor_id, mine, id AS positive_id, score AS positive_score FROM scored WHERE label = mine
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.mine
         AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
"""
