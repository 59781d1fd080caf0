"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately; a pair of centroids is a
cell. A query sorts the centroids of each half by distance and walks the pairs
in the order of their summed distance with a heap, until the cells it has
passed hold ``PROBED`` of all vectors (``LEAST`` at least). The vectors of
those cells are reranked by the true inner product.

For the order of cells to be that of the inner product whatever the norms,
each half gets one more component that brings all halves to the norm of the
longest (a query's is zero): nearest is then largest inner product.

The codebooks are fitted on ``SAMPLE`` vectors at most (by hash); every vector
is in the index. A cell's vectors are dealt over blocks of about
``BLOCK_ROWS``; small cells share a block, large ones have several. A task
holds one block and streams the queries that probe it, so its memory does not
depend on the number of queries or on one cell's size; queries are dealt over
parts of ``QUERY_ROWS`` on average. A task merges what its blocks give to a query into its
``k`` best, and a running top-k merges the tasks'.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, those of another length than most, and null ids take no part;
repeated rows count once; of equal vectors the k + 1 smallest ids are enough
and no others are kept; ties go to the smaller id; a query with fewer than k
candidates gets them all; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 8_192
CENTROIDS = 64
PROBED = 0.5
LEAST = 2_000
BLOCK_ROWS = 1_024
QUERY_ROWS = 50_000
_ROUNDS = 15


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")).where(F.col("id").isNotNull() & good)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(1)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids, started from rows spread over the sample."""
    centroids = np.unique(x, axis=0)
    if len(centroids) <= k:
        return centroids
    centroids = x[np.random.default_rng(7).choice(len(x), k, replace=False)]
    for _ in range(_ROUNDS):
        nearest = _distances(x, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=k)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


class Codebooks:
    """Centroids of both halves and the norm that halves are brought to."""

    def __init__(self, sample: np.ndarray, centroids: int, norms: tuple[float, float]) -> None:
        self.half = sample.shape[1] // 2
        self.norms = norms
        self.books = [k_means(x, centroids) for x in self.halves(sample)]

    def halves(self, x: np.ndarray, query: bool = False) -> list[np.ndarray]:
        out = []
        for part, norm in zip((x[:, : self.half], x[:, self.half :]), self.norms, strict=True):
            rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm - (part**2).sum(1), 0))
            out.append(np.column_stack([part, rest]))
        return out

    @property
    def width(self) -> int:
        return len(self.books[1])

    def cell(self, x: np.ndarray) -> np.ndarray:
        one, two = (_distances(h, b).argmin(1) for h, b in zip(self.halves(x), self.books, strict=True))
        return one * self.width + two

    def walk(self, query: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Cells in the order of summed distance, until ``wanted`` vectors are passed."""
        one, two = (_distances(h, b)[0] for h, b in zip(self.halves(query[None], query=True), self.books, strict=True))
        first, second = one.argsort(kind="stable").tolist(), two.argsort(kind="stable").tolist()
        heap, reached, cells, passed = [(one[first[0]] + two[second[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and passed < wanted:
            _, i, j = heapq.heappop(heap)
            cell = first[i] * self.width + second[j]
            if counts[cell]:
                cells.append(cell)
                passed += int(counts[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(first) and b < len(second) and (a, b) not in reached:
                    reached.add((a, b))
                    heapq.heappush(heap, (one[first[a]] + two[second[b]], a, b))
        return cells


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_BLOCK = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("query", pa.bool_()), ("id", pa.int64()), ("v", pa.list_(pa.float64())), ("cells", pa.list_(pa.int32()))])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def best_of_block(ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, probed: list[np.ndarray], k: int) -> pa.RecordBatch:
    """The k best of the block's vectors for each query, among the cells it probes."""
    scores = queries @ vectors.T
    scores[query_ids[:, None] == ids[None]] = -np.inf
    for row, allowed in zip(scores, probed, strict=True):
        row[~np.isin(cells, allowed)] = -np.inf
    at = np.arange(scores.shape[1])
    if len(at) > k:  # with all that tie within rounding
        edge = np.partition(scores, len(at) - k, axis=1)[:, len(at) - k]
        take = scores >= (edge - 1e-9 * np.maximum(1, np.abs(edge)))[:, None]
    else:
        take = np.ones_like(scores, bool)
    q, c = np.nonzero(take & np.isfinite(scores))
    exact = (queries[q] * vectors[c]).sum(axis=1)
    order = np.lexsort((ids[c], -exact, q))
    q, c, exact = q[order], c[order], exact[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < k
    return pa.RecordBatch.from_arrays([pa.array(query_ids[q[keep]]), pa.array(ids[c[keep]]), pa.array(exact[keep])], schema=_FOUND)


def merge(found: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """The k best rows of each query."""
    q, ids, score = (np.concatenate([b.column(c).to_numpy() for b in found]) for c in range(3))
    order = np.lexsort((ids, -score, q))
    q = q[order]
    keep = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (np.concatenate([b.column(0).to_numpy() for b in found]), ids, score)], schema=_FOUND)


def search(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, probed: float = PROBED, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    given = usable(rows, id_col, vector_col)
    common = given.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return empty
    size = common["size"]
    given = given.where(F.size("v") == size)
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = stored(given.distinct().withColumn("n", smallest).where(F.col("n") <= k + 1).drop("n"), "vectors")
    half = size // 2
    square = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x * x)
    norms = kept.agg(F.max(square(F.slice("v", 1, half) if half else F.array().cast("array<double>"))).alias("a"), F.max(square(F.slice("v", half + 1, size - half))).alias("b"), F.count("*").alias("n")).first()
    sample = np.array([r.v for r in kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toLocalIterator()], float)
    books = Codebooks(sample, centroids, (norms.a, norms.b))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.cell(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))], names=["id", "v", "cell"])

    celled = stored(kept.select("id", "v").mapInArrow(assign, "id long, v array<double>, cell int"), "cells")
    counts = np.zeros(len(books.books[0]) * books.width, np.int64)
    for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most centroids ** 2 rows
        counts[r.cell] = r.n
    pieces = np.maximum(1, -(-counts // BLOCK_ROWS))
    # small cells share a block, in cell order; a large one has its own
    block_of, block, room = np.zeros(len(counts), np.int64), -1, 0
    for cell, n in enumerate(counts.tolist()):
        if n > BLOCK_ROWS or n > room:
            block += 1
            room = BLOCK_ROWS
        block_of[cell] = block
        room -= n
        if n > BLOCK_ROWS:
            block, room = block + int(pieces[cell]) - 1, 0
    wanted = max(least, int(np.ceil(probed * norms.n)))
    asked = usable(queries, id_col, vector_col).where(F.size("v") == size).distinct()
    parts = max(1, -(-asked.count() // QUERY_ROWS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            at = block_of[cell] + ids % pieces[cell]
            for p in range(parts):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(ids), p)), pa.array(np.zeros(len(ids), bool)), batch.column(0), batch.column(1), pa.array([[c] for c in cell.tolist()], pa.list_(pa.int32()))], schema=_BLOCK)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query, v = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                cells = np.sort(np.array(books.walk(np.array(v), counts, wanted + 1), np.int64))
                by_block: dict[int, list[int]] = {}
                for c in cells.tolist():
                    for piece in range(int(pieces[c])):
                        by_block.setdefault(int(block_of[c]) + piece, []).append(c)
                n = len(by_block)
                yield pa.RecordBatch.from_arrays([pa.array(list(by_block), pa.int64()), pa.array([query // 7 % parts] * n, pa.int64()), pa.array([True] * n), pa.array([query] * n, pa.int64()), pa.array([v] * n, pa.list_(pa.float64())), pa.array(list(by_block.values()), pa.list_(pa.int32()))], schema=_BLOCK)

    ddl = "block long, part long, query boolean, id long, v array<double>, cells array<int>"
    both = celled.mapInArrow(place, ddl).unionByName(asked.mapInArrow(probe, ddl))
    dealt = both.repartition("block", "part").sortWithinPartitions("part", "block", "query")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of a part's queries over all blocks of the task: at most
        QUERY_ROWS * k rows, and a few blocks' more before they are merged."""
        here, ids, vectors, cells = None, [], [], []
        best: list[pa.RecordBatch] = []
        held = merged = 0
        for batch in batches:
            key = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]).astype(np.int64)
            if not len(key):
                continue
            cuts = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
                run = batch.slice(a, b - a)
                if (key[a, 0], key[a, 1]) != here:
                    if here and here[1] != key[a, 1] and best:
                        yield merge(best, k)
                        best, held, merged = [], 0, 0
                    here, ids, vectors, cells = (key[a, 0], key[a, 1]), [], [], []
                if not key[a, 2]:
                    ids.append(run.column(3).to_numpy())
                    vectors.append(_matrix(run.column(4)))
                    cells.append(run.column(5).flatten().to_numpy())
                elif ids:
                    for at in range(0, run.num_rows, 512):
                        part = run.slice(at, 512)
                        probed_cells = [np.array(x, np.int64) for x in part.column(5).to_pylist()]
                        best.append(best_of_block(np.concatenate(ids), np.concatenate(vectors), np.concatenate(cells), part.column(3).to_numpy(), _matrix(part.column(4)), probed_cells, k))
                        held += best[-1].num_rows
                        if held > max(200_000, 2 * merged):
                            best = [merge(best, k)]
                            held = merged = best[0].num_rows
        if best:
            yield merge(best, k)

    found = dealt.mapInArrow(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
