"""Keyed building blocks that stay correct and balanced when one key holds
a large share of all rows.

* ``bounded_broadcast`` — broadcast a side only after measuring it against a
  bound in rows and bytes; beyond the bound the caller gets a plain shuffle join (AQE
  skew-join splits hot keys there).
* ``first_per_key`` / ``last_per_key`` — ``row_number() = 1`` without a
  window: ``min``/``max`` over a struct is a partial aggregate, so a hot key
  collapses map-side to one row per task before the shuffle.
* ``prev_value`` — ``last(value) ignore nulls`` over the rows *before* the
  current one within a key (``lag`` when values are never NULL, as-of
  lookup when only some rows carry a value). The window runs per
  (key, bucket) so a hot key is split into many tasks; the value that
  crosses a bucket border comes from a small per-(key, bucket) table.
* ``prev_value_by_density`` — the same with the input evaluated once, and
  buckets for those keys only that have too many rows for one window.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side we broadcast, in rows and in bytes of its values. Callers
# project the side to the columns they need first.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 << 20


def sized(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    materialize: bool = False,
    bound_by: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """(side, fits): whether ``df`` has at most ``max_rows`` rows and
    BROADCAST_MAX_BYTES bytes.
    ``materialize`` first checkpoints a side that is derived from big data,
    so the count and the join do not compute it twice (and its lineage is
    cut). ``bound_by`` is a cheaper frame with at least as many rows as
    ``df`` (e.g. before a de-duplication) whose count bounds it."""
    if materialize:
        from millrun.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)  # shared folder (set only for local masters)
        df = df.checkpoint(eager=True)
        return df, _fits(df, max_rows)
    return df, _fits(df if bound_by is None else bound_by, max_rows)


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    materialize: bool = False,
    bound_by: DataFrame | None = None,
) -> DataFrame:
    """Return ``broadcast(df)`` if it has at most ``max_rows`` rows, else
    ``df`` unchanged (shuffle join); see ``sized``."""
    df, fits = sized(df, max_rows, materialize, bound_by)
    return F.broadcast(df) if fits else df


def _fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and BROADCAST_MAX_BYTES
    bytes of values; reads no more than the bound. Counted each time: files
    may be replaced under the same name."""

    def width(f) -> Column:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(8)
        text = f"`{f.name}`" if isinstance(f.dataType, (T.StringType, T.BinaryType)) else f"to_json(array(`{f.name}`))"
        return F.expr(f"8 + coalesce(octet_length({text}), 0)")

    row = sum((width(f) for f in df.schema.fields), F.lit(0))
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_MAX_BYTES


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str] | None = None
) -> DataFrame:
    """Row with the smallest ``order`` per key (ties: smallest payload)."""
    return _extreme_per_key(df, keys, order, payload, F.min)


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str] | None = None
) -> DataFrame:
    """Row with the largest ``order`` per key — last-writer-wins."""
    return _extreme_per_key(df, keys, order, payload, F.max)


def _extreme_per_key(df, keys, order, payload, agg):
    keys, order = list(keys), list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order]
    if len(order) == 1 and not payload:  # one plain value: a hash aggregate, no sort
        return df.groupBy(*keys).agg(agg(order[0]).alias(order[0]))
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [
        F.col(c) for c in payload
    ]
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"))
    return picked.select(
        *keys,
        *[F.col(f"_pick._o{i}").alias(c) for i, c in enumerate(order)],
        *[F.col(f"_pick.{c}").alias(c) for c in payload],
    )


def prev_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """Add ``out`` = the last non-NULL ``value`` among rows of the same key
    strictly before this row in ``order``.

    ``bucket`` must be non-decreasing in ``order`` within a key (e.g.
    ``floor(seq / width)``); it splits the per-key window into independent
    tasks. Exact for any bucket choice; the bucket only bounds the work of
    one task.
    """
    keys, order = list(keys), list(order)
    b = "_bucket"
    staged = df.withColumn(b, bucket)
    w_local = (
        Window.partitionBy(*keys, b)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = staged.withColumn("_local", F.last(value, ignorenulls=True).over(w_local))
    # Last non-NULL value of each (key, bucket): a partial aggregate of the
    # pruned input (key, bucket, order, value), so a hot key shuffles one
    # row per bucket and map task. (Taking it from the window output
    # instead would shuffle every narrow row: the two branches prune to
    # different columns, so Spark cannot reuse one exchange for both.)
    order_struct = F.struct(*[F.col(c) for c in order])
    per_bucket = staged.groupBy(*keys, b).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order_struct)).alias("_blast")
    )
    w_carry = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        *keys, b, F.last("_blast", ignorenulls=True).over(w_carry).alias("_carry")
    )
    joined = local.join(carry, on=[*keys, b], how="left")
    return joined.withColumn(out, F.coalesce(F.col("_local"), F.col("_carry"))).drop(
        "_local", "_carry", b
    )


# A key with more rows is cut into buckets; one window holds no more of a key.
KEY_ROWS = 1 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back."""
    from millrun.session import checkpoint_dir

    path = f"{checkpoint_dir(df.sparkSession)}/written-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fine_bucket(df: DataFrame, order: str) -> Column:
    """A small stretch of ``order``, by its type: one second of a time or of
    the queue's order of arrival (text that begins with 20 digits of
    microseconds), 1,024 of a number."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.StringType):
        return F.substring(order, 1, 14)
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(order) / F.lit(1_024))
    return F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(1_000_000))


def prev_value_by_density(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    key_rows: int = KEY_ROWS,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``prev_value`` whose buckets follow the data: a key of at most
    ``key_rows`` rows is one window; only a key above is cut, into stretches
    of the first order column as short as ``fine_bucket`` makes them, which
    the shuffle deals over all tasks however close in time its rows lie.

    ``df`` is evaluated once: it is written, and the count of rows per key,
    the windows and the values carried into a stretch read what is written,
    each its own columns. The keys above ``key_rows`` are at most
    rows / ``key_rows``; no others have carried values. The join with those
    has the windows' partitioning, so the rows are shuffled once. Rows with
    a NULL key have no previous value, whatever their number."""
    keys, order = list(keys), list(order)
    once = written(df, "rows")
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    many = once.filter(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > key_rows)
    hot = bounded_broadcast(many.select(*keys, F.lit(True).alias("_hot")), max_rows, materialize=True)
    fine = fine_bucket(once, order[0])
    cut = F.when(F.col("_hot") | ~keyed, fine)
    staged = once.join(hot, keys, "left").withColumn("_bucket", F.coalesce(cut, F.lit(0).cast(once.select(fine.alias("b")).schema["b"].dataType))).drop("_hot")
    before = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumn("_local", F.last(value, ignorenulls=True).over(before))

    at = F.struct(*[F.col(c) for c in order])
    cells = (
        once.join(hot, keys, "left_semi")
        .withColumn("_bucket", fine)
        .groupBy(*keys, "_bucket")
        .agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), at)).alias("_last"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = cells.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    joined = local.join(carry, [*keys, "_bucket"], "left")
    return joined.select(*df.columns, F.when(keyed, F.coalesce("_local", "_carry")).alias(out))
