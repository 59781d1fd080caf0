"""Centroid clustering of integer vectors by scalar lookup tables.

A component becomes ``floor(scale * x)``. The vectors are written once as
blocks of ``BLOCK_ROWS``: a block keeps, for each dimension, the integer values
that occur in it and each vector's place among them. A round tabulates the
squared difference of every dimension, occurring value and centroid of a block
once; a distance is then a sum of gathers from these tables, with no further
subtraction or product per vector. Sums of a cluster come from the counts of
(cluster, value) in the same way. All of it is integer arithmetic.

A task holds one block and k * size sums; Spark adds the tasks' sums, so the
driver sees k * size numbers a round. Blocks are cut by rows, so no cluster
and no repeated vector makes a task larger than another.

Defined cases: vectors that are null, of another size, or with null or
non-finite components take no part, nor do those with a component whose integer
is ``LIMIT`` or more (squared distances would not fit in a long); repeated rows
are vectors of their own; a null id is kept and hashed as an empty text; rows
with equal hashes start in the order of their components; with fewer than k
vectors there are as many centroids; an empty centroid stays; ties go to the
smaller number; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS = 4_096
LIMIT = 1 << 27

_BLOCK_SQL = "ids array<long>, many array<int>, vals binary, codes binary"
_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("many", pa.list_(pa.int32())), ("vals", pa.binary()), ("codes", pa.binary())])
_SUMS_SQL = "cluster int, dim int, n long, total long"
_SUMS = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])
_ASSIGNED_SQL = "vec_id long, cluster int, distance long"
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(id, v) of the rows that take part, with integer components."""
    x = F.col(vector_col).cast("array<double>")
    fit = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float(LIMIT // scale)))
    good = rows.where(F.coalesce((F.size(x) == size) & fit, F.lit(False)))
    return good.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e * float(scale)).cast("long")).alias("v"))


def start_order(id_col: str, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)


def _to_blocks(size: int):
    def block(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(parts)
        vals, codes = zip(*(np.unique(x[:, d], return_inverse=True) for d in range(size)), strict=True)
        many = [len(v) for v in vals]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([pa.concat_arrays(ids).to_pylist()], _BLOCK.field("ids").type),
                pa.array([many], _BLOCK.field("many").type),
                pa.array([np.concatenate(vals).astype("<i8").tobytes()]),
                pa.array([np.stack([c.reshape(-1) for c in codes]).astype("<u2").tobytes()]),
            ],
            schema=_BLOCK,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            at = 0
            while at < len(x):
                take = min(len(x) - at, BLOCK_ROWS - held)
                ids.append(batch.column(0).slice(at, take))
                parts.append(x[at : at + take])
                at, held = at + take, held + take
                if held == BLOCK_ROWS:
                    yield block(ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield block(ids, parts)

    return run


class _Block:
    def __init__(self, batch: pa.RecordBatch, row: int, size: int) -> None:
        self.ids = batch.column(0)[row].values
        ends = np.cumsum(np.array(batch.column(1)[row].as_py()))[:-1]
        self.vals = np.split(np.frombuffer(batch.column(2)[row].as_buffer(), "<i8"), ends)
        self.codes = np.frombuffer(batch.column(3)[row].as_buffer(), "<u2").reshape(size, -1)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of each vector to each centroid: table gathers and sums."""
        out = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for vals, codes, c in zip(self.vals, self.codes, centroids.T, strict=True):
            table = (vals[:, None] - c[None, :]) ** 2
            out += table[codes]
        return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[_Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Block(batch, row, size)


def _sums(centroids: np.ndarray):
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for block in _blocks(batches, size):
            nearest = block.distances(centroids).argmin(axis=1)
            n += np.bincount(nearest, minlength=k)
            for d, (vals, codes) in enumerate(zip(block.vals, block.codes, strict=True)):
                seen = np.bincount(nearest * len(vals) + codes, minlength=k * len(vals)).reshape(k, -1)
                total[:, d] += seen @ vals
        cluster, dim = np.divmod(np.arange(k * size, dtype=np.int32), np.int32(size))
        columns = [cluster, dim, np.repeat(n, size), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_SUMS)

    return run


def _assign(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, centroids.shape[1]):
            distances = block.distances(centroids)
            nearest = distances.argmin(axis=1)
            best = distances[np.arange(len(nearest)), nearest]
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(nearest.astype(np.int32)), pa.array(best)], schema=_ASSIGNED)

    return run


def cluster(rows: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    vectors = integer_vectors(rows, id_col, vector_col, size, scale)
    first = vectors.orderBy(start_order("id", salt), "v").limit(k).select("v").collect()
    if not first:
        return rows.sparkSession.createDataFrame([], _ASSIGNED_SQL), np.empty((0, size), np.int64)
    centroids = np.array([r.v for r in first], np.int64)
    blocks = stored(vectors.mapInArrow(_to_blocks(size), _BLOCK_SQL), "blocks")
    for _ in range(rounds):
        sums = blocks.mapInArrow(_sums(centroids), _SUMS_SQL).groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        moved = centroids.copy()
        for r in sums.where("n > 0").collect():  # k * size rows
            moved[r.cluster, r.dim] = r.total // r.n
        if (moved == centroids).all():
            break  # further rounds would repeat this one
        centroids = moved
    return stored(blocks.mapInArrow(_assign(centroids), _ASSIGNED_SQL), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256."""
    sums = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows
    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    place = F.col("cluster") + 1
    of_cluster = F.array(*[F.lit(sums.get(i, 0)).cast("long") for i in range(len(texts))])
    digests = F.array(*[F.lit(hashlib.sha256(t.encode()).hexdigest()) for t in texts])
    if not texts:
        return assigned.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    return assigned.select("*", F.element_at(of_cluster, place).alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), F.element_at(digests, place).alias("centroid_sha256"))


def oracle_sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    """The same by plain differences and joins, in DuckDB SQL."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"dims AS MATERIALIZED (SELECT r, CAST(i AS INTEGER) AS d, v[i] AS x FROM kept, range(1, {size + 1}) t(i))",
        f"""first AS (
            SELECT v, row_number() OVER (ORDER BY sha256('{salt}' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c
            FROM kept QUALIFY c < {k})""",
        f"c0 AS MATERIALIZED (SELECT c, CAST(i AS INTEGER) AS d, v[i] AS y FROM first, range(1, {size + 1}) t(i))",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS distance FROM dims JOIN c{n} USING (d) GROUP BY r, c
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1)""")
        if n < rounds:
            parts.append(f"""m{n} AS (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM dims JOIN a{n} USING (r) GROUP BY c, d),
        c{n + 1} AS MATERIALIZED (
            SELECT c{n}.c, c{n}.d, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{n} LEFT JOIN m{n} ON m{n}.c = c{n}.c AND m{n}.d = c{n}.d)""")
    last = f"a{rounds}"
    return f"""
        WITH {', '.join(parts)},
        shas AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM {last} JOIN kept USING (r) JOIN shas USING (c)
    """
