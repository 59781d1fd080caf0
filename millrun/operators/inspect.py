"""Inspection operators of the DWM layer.

* ``interval_join`` — inspection header x detail rows of the same order
  whose times differ by at most the bounds (both ends included).
* ``first_defect_per_size`` — the "independent size" feed: one defective
  detail per (size, production id, day).
* ``recheck_rows`` — the "re-inspected size" feed: every detail of a
  (production id, size) after its first inspection.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrun.operators.keyed import bounded_broadcast, first_per_key


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower_ms: int = -5000,
    upper_ms: int = 5000,
    bucket_ms: int | None = None,
    right_key: str | None = None,
) -> DataFrame:
    """Inner join on ``key`` (``right_key`` on the right, default the same) where ``right_ts`` lies in
    [left_ts + lower_ms, left_ts + upper_ms].

    Besides the key, both sides carry a time bucket as a second equi-key
    (the right row's bucket; every bucket the left row's interval touches),
    so one busy key is spread over many join tasks instead of one, and the
    range test runs only against rows of nearby buckets. The range
    predicate stays in the join condition, which is also what lets a
    streaming run evict state behind the watermarks.
    """
    # Compare in microseconds: timestamps keep sub-millisecond digits.
    lo, hi = lower_ms * 1000, upper_ms * 1000
    width = (bucket_ms * 1000) if bucket_ms else max(hi - lo, 1)
    lt = F.unix_micros(F.col(left_ts).cast("timestamp"))
    rt = F.unix_micros(F.col(right_ts).cast("timestamp"))
    l_buckets = F.sequence(
        F.floor((lt + F.lit(lo)) / F.lit(width)), F.floor((lt + F.lit(hi)) / F.lit(width))
    )
    right_key = right_key or key
    lb = left.withColumn("_ljb", F.explode(l_buckets)).alias("_l")
    rb = right.withColumn("_rjb", F.floor(rt / F.lit(width))).alias("_r")
    cond = (
        (F.col(f"_l.{key}") == F.col(f"_r.{right_key}"))
        & (F.col("_l._ljb") == F.col("_r._rjb"))
        & (F.col(f"_r.{right_ts}") >= F.col(f"_l.{left_ts}") + F.lit(timedelta(microseconds=lo)))
        & (F.col(f"_r.{right_ts}") <= F.col(f"_l.{left_ts}") + F.lit(timedelta(microseconds=hi)))
    )
    return lb.join(rb, cond, "inner").drop("_ljb", "_rjb")


def first_defect_per_size(
    details: DataFrame,
    mid: str = "mid",
    size_id: str = "size_id",
    day: str = "day",
    is_pass: str = "isPass",
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """First failed detail per (production id, size, day)."""
    defects = details.filter(~F.coalesce(F.col(is_pass) == "1", F.lit(False)))
    payload = [c for c in details.columns if c not in (mid, size_id, day, *order)]
    return first_per_key(defects, [mid, size_id, day], list(order), payload)


def recheck_rows(
    details: DataFrame,
    mid: str = "mid",
    size_id: str = "size_id",
    order: Sequence[str] = ("ts", "detail_id"),
) -> DataFrame:
    """Details of a (production id, size) that was inspected before: every
    row but the first by ``order``. ``order`` must end with a unique detail
    id so that exactly one row per key is the first."""
    order = list(order)
    first = first_per_key(details.select(mid, size_id, *order), [mid, size_id], order)
    first = first.select(F.col(mid).alias("_mid"), F.col(size_id).alias("_size"), F.struct(*order).alias("_first"))
    first = bounded_broadcast(first, materialize=True)
    # NULL keys are a key of their own, as in the stream and the counts
    same = F.col(mid).eqNullSafe(F.col("_mid")) & F.col(size_id).eqNullSafe(F.col("_size"))
    joined = details.join(first, same, "inner")
    return joined.filter(~F.struct(*order).eqNullSafe(F.col("_first"))).drop("_first", "_mid", "_size")


def recheck_counts(details: DataFrame, mid: str = "mid", size_id: str = "size_id") -> DataFrame:
    """Re-inspections per (production id, size): rows after the first."""
    return (
        details.groupBy(mid, size_id)
        .agg((F.count(F.lit(1)) - 1).cast("bigint").alias("n_recheck"))
        .filter(F.col("n_recheck") > 0)
    )
