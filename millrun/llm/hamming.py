"""Exact top-k search in Hamming space by incremental multi-index hashing.

A 64-bit code is cut into ``SEGMENTS`` segments; the index has a row for each
distinct code and segment. Round r looks up, for every open query, all segment
values at exactly r bits from the query's own. Whatever differs from the query
in at most ``SEGMENTS * (r + 1) - 1`` bits has a segment within r bits, so it
has been found by then; a query closes once its k-th verified distance lies
within that. Verification is the popcount of the whole codes, and what is
farther than the k-th so far is not looked at again. A pair that
several segments find is kept by the first segment of its least radius only,
so nothing is collected twice and no distinct is needed.

Rows with equal codes are one index entry with their number and their k + 1
smallest ids (a running top-k before the shuffle), which is all a result can
need. Queries with equal codes are one search.

Defined cases: null codes and null ids take no part; a query's own id is no
result of it; ties go to the smaller id; repeated rows count once; with fewer
than k others a query gets them all; an empty table gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BITS = 64
SEGMENTS = 4
_WIDTH = BITS // SEGMENTS
_LOW = (1 << _WIDTH) - 1


def sign_code(vector: str) -> Column:
    """Bit i is set where component i (of the first 64) is above zero; null for
    a null or empty vector and for null or non-finite components."""
    v = F.expr(f"slice({vector}, 1, {BITS})")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bits = F.transform(v, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when((F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)), code)


def _segment(code: Column, k: int) -> Column:
    return F.shiftrightunsigned(code, _WIDTH * k).bitwiseAND(F.lit(_LOW)).cast("int")


def _bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(query_id, rank, vec_id, distance): the k rows nearest to each query row."""
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(code_col).cast("long").alias("code")).dropna().distinct()
    asked = stored(queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(code_col).cast("long").alias("q")).dropna().distinct(), "queries")
    smallest = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = stored(base.withColumn("n", smallest).where(F.col("n") <= k + 1).drop("n"), "members")
    codes = members.groupBy("code").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    index = stored(codes.select("code", "least", "rows", F.posexplode(F.array(*[_segment(F.col("code"), s) for s in range(SEGMENTS)])).alias("segment", "value")), "segments")

    best = None
    open_queries = asked.select("q", F.lit(BITS).alias("bound")).distinct()
    near_first = Window.partitionBy("q").orderBy("distance", "least", "code")
    for r in range(_WIDTH + 1):
        shell = ",".join(str(sum(1 << b for b in bits)) for bits in itertools.combinations(range(_WIDTH), r))
        probes = open_queries.select("q", "bound", F.explode(F.split(F.lit(shell), ",").cast("array<int>")).alias("mask"))
        probes = probes.select("q", "bound", F.posexplode(F.array(*[_segment(F.col("q"), s).bitwiseXOR(F.col("mask")) for s in range(SEGMENTS)])).alias("segment", "value"))
        apart = [_bits(_segment(F.col("q"), s), _segment(F.col("code"), s)) for s in range(SEGMENTS)]
        first = F.lit(True)
        for s in range(SEGMENTS):
            first = first & F.when(F.col("segment") > s, apart[s] > r).when(F.col("segment") < s, apart[s] >= r).otherwise(True)
        distance = _bits(F.col("q"), F.col("code"))
        # verified as part of the join: what is beyond the best k + 1 so far never leaves it
        # both sides are shuffled: probes look small to the planner but are not bounded
        found = probes.hint("merge").join(index, ["segment", "value"]).where(first & (distance <= F.col("bound"))).select("q", "code", "least", "rows", distance.alias("distance"))
        if best is None:
            top = found
        else:
            top = best.join(open_queries.select("q"), "q", "left_semi").unionByName(found)
        top = top.withColumn("n", F.row_number().over(near_first)).where(F.col("n") <= k + 1).drop("n")
        if best is not None:
            top = top.unionByName(best.join(open_queries.select("q"), "q", "left_anti"))
        best = stored(top, f"best-{r}")
        # the distance within which k + 1 rows are known (the query's own is among them)
        passed = F.sum("rows").over(near_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        known = best.withColumn("passed", passed).where(F.col("passed") > k).groupBy("q").agg(F.min("distance").alias("bound"))
        certain = SEGMENTS * (r + 1) - 1
        still = open_queries.select("q").join(known, "q", "left").select("q", F.coalesce("bound", F.lit(BITS)).alias("bound"))
        open_queries = stored(still.where(F.col("bound") > certain), f"open-{r}")
        if open_queries.isEmpty():
            break
    rows_found = best.select("q", "code", "distance").join(members, "code").join(asked, "q").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return rows_found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").cast("int").alias("distance"))
