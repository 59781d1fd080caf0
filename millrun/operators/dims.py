"""Dim (lookup) tables: schema from a rule, last-writer-wins upserts into
a versioned store (``millrun.sources.dimstore``), and enrichment joins.
Lookups are joins against a snapshot — broadcast when its row count is
under the bound, shuffled otherwise — so there is no per-row call and no
cache to keep in step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrun.operators.keyed import bounded_broadcast, last_per_key, prev_value, prev_value_by_density
from millrun.sources.dimstore import BUCKETS, DimStore, bucket_of

DIM_MAX_ROWS = 1_000_000


def dim_schema(columns: Sequence[str], pk: str = "id") -> T.StructType:
    """All-string schema of a dim table from its rule's column list."""
    cols = [c.strip() for c in columns if c and c.strip()]
    if pk not in cols:
        raise ValueError(f"pk column {pk!r} is not in sink_columns {cols}")
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def ensure_dim_table(spark: SparkSession, root: str, sink_table: str, columns: Sequence[str], pk: str = "id") -> None:
    """Create the dim table, empty, if none exists."""
    dim_schema(columns, pk)
    store = DimStore(spark, root, sink_table)
    if store.latest() is None:
        store.commit(None, [], columns, pk)


def project_data(routed: DataFrame, columns: Sequence[str], presence: bool = False) -> DataFrame:
    """``data`` map -> one string column per sink column; keys outside the
    list are dropped, missing columns are NULL. With ``presence`` each
    column also gets ``_has_<column>``: whether the record carried it (a
    record may carry a column set to NULL)."""
    data = F.col("data")
    flags = [F.coalesce(F.map_contains_key(data, F.lit(c)), F.lit(False)).alias(f"_has_{c}")
             for c in columns] if presence else []
    return routed.select(
        *[c for c in routed.columns if c != "data"],
        *[data.getItem(c).alias(c) for c in columns],
        *flags,
    )


def latest_changes(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str = "seq",
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """Last-writer-wins per key: the change with the highest ``seq``.
    A partial aggregate, so a key updated millions of times costs one row
    per map task in the shuffle."""
    return last_per_key(changes, keys, [seq], payload)


def merge_snapshot(
    current: DataFrame | None,
    changes: DataFrame,
    pk: str,
    columns: Sequence[str],
    seq: str = "seq",
    op: str = "type",
    deletes: str = "remove",
) -> DataFrame:
    """New snapshot after applying ``changes`` in ``seq`` order.

    An upsert writes the columns the record carries (``_has_<column>``
    flags from ``project_data(presence=True)``; without them every column
    counts as carried): other columns keep their stored value. With
    ``deletes="remove"`` a delete drops the key, and only later changes
    rebuild it; ``deletes="upsert"`` treats deletes like any write.

    One partial aggregate per key — for each column, the latest change
    that wrote it or deleted the row — so a key changed millions of times
    costs one row per map task; then one join with the stored snapshot.
    """
    if deletes not in ("remove", "upsert"):
        raise ValueError("deletes must be 'remove' or 'upsert'")
    cols = [c for c in columns if c != pk]
    absent = [c for c in cols if c not in changes.columns]  # columns that only stored rows have
    changes = changes.select("*", *[F.lit(None).cast("string").alias(c) for c in absent], *[F.lit(False).alias(f"_has_{c}") for c in absent])
    is_del = (F.col(op) == "delete") if deletes == "remove" else F.lit(False)
    staged = changes.filter(F.col(pk).isNotNull()).withColumn("_del", F.coalesce(is_del, F.lit(False)))
    has = {c: (F.col(f"_has_{c}") if f"_has_{c}" in changes.columns else F.lit(True)) for c in cols}
    agg = staged.groupBy(pk).agg(
        F.max_by(F.col("_del"), F.col(seq)).alias("_gone"),
        *[
            F.max_by(
                F.struct(F.col("_del").alias("d"), F.col(c).alias("v")),
                F.when(has[c] | F.col("_del"), F.col(seq)),
            ).alias(f"_w_{c}")
            for c in cols
        ],
    )
    if current is None:  # nothing stored yet: no join
        merged = agg.select("*", *[F.lit(None).cast("string").alias(f"_cur_{c}") for c in cols])
    else:
        cur = current.select(pk, *[F.col(c).alias(f"_cur_{c}") for c in cols])
        merged = cur.join(agg, on=pk, how="full_outer")

    def value(c: str):
        w = F.col(f"_w_{c}")
        return F.when(w.isNull(), F.col(f"_cur_{c}")).when(w["d"], F.lit(None)).otherwise(w["v"]).alias(c)

    kept = merged.filter(F.col("_gone").isNull() | ~F.col("_gone"))
    return kept.select(*[F.col(pk) if c == pk else value(c) for c in columns])


def read_snapshot(
    spark: SparkSession, root: str, sink_table: str, before: int | None = None
) -> DataFrame | None:
    """Newest committed version of a dim table (optionally the newest below
    ``before``), or None if there is none. Any other error is raised."""
    store = DimStore(spark, root, sink_table)
    entry = store.latest(before)
    return None if entry is None else store.read(entry)


def upsert_dim(
    spark: SparkSession,
    changes: DataFrame,
    root: str,
    sink_table: str,
    pk: str,
    columns: Sequence[str],
    version: int,
    seq: str = "seq",
    op: str = "type",
    deletes: str = "remove",
    run: str = "",
) -> DataFrame:
    """Merge ``changes``, batch ``version`` of ``run`` (a stream's query id),
    into the table and return the new snapshot.

    The table numbers its versions itself, so a fresh checkpoint (batch ids
    from 0 again, under another run) adds to what is stored; a replay of a
    batch that is committed changes nothing. Only the hash buckets that the
    changes touch are read and rewritten. Columns that the table has and
    the rule no longer lists stay; new ones are NULL in stored rows."""
    store = DimStore(spark, root, sink_table)
    entry = store.latest()
    if entry is not None and store.applied(run, int(version)):
        return store.read(entry)
    kept = list(entry["columns"]) if entry is not None else []
    columns = kept + [c for c in columns if c not in kept]
    buckets = entry["n_buckets"] if entry is not None else BUCKETS
    keyed = changes.filter(F.col(pk).isNotNull())
    touched = sorted(r[0] for r in keyed.select(bucket_of(pk, buckets)).distinct().collect())  # at most n_buckets
    current = store.read(entry, touched, columns) if entry is not None else None
    merged = merge_snapshot(current, keyed, pk, columns, seq, op, deletes)
    return store.read(store.commit(merged, touched, columns, pk, run, int(version)))


# ------------------------------------------------------------------ lookups


def enrich(
    df: DataFrame,
    dim: DataFrame,
    left_key: str | Column,
    dim_key: str,
    columns: Mapping[str, str],
    how: str = "left",
    max_rows: int = DIM_MAX_ROWS,
) -> DataFrame:
    """Look up ``columns`` (dim column -> output name) by key. Rows without
    a dim row keep NULLs. The dim side is projected to the key and the
    wanted columns, reduced to one row per key, then broadcast if small."""
    outs = list(columns.values())
    raw = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(o) for c, o in columns.items()])
    # One row per key, chosen deterministically (the greatest), so a task
    # recomputed after an executor loss picks the same row. The raw row
    # count bounds the de-duplicated side: one scan, no shuffle.
    one = last_per_key(raw, ["_dim_key"], outs, []) if outs else raw.distinct()
    side = bounded_broadcast(one, max_rows, bound_by=raw)
    key = F.col(left_key) if isinstance(left_key, str) else left_key
    return df.join(side, key == F.col("_dim_key"), how).drop("_dim_key")


def enrich_asof(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    dim_key: str,
    dim_ts: str,
    dim_seq: str,
    columns: Sequence[str],
    bucket_ms: int | None = None,
) -> DataFrame:
    """Dim value valid at event time: the dim version with the latest
    (dim_ts, dim_seq) not after the event's ``ts`` (versions at the same
    instant as the event count); NULL keys match nothing. Exact. Events and
    versions are one input, evaluated once; keys with very many rows are cut
    by density (``prev_value_by_density``). ``bucket_ms`` instead cuts every
    key in time buckets of a fixed width."""
    version = F.struct(F.col(dim_seq).alias("_dim_seq"), *[F.col(c) for c in columns])
    ver = dim.filter(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("_k"),
        F.col(dim_ts).cast("timestamp").alias("_t"),
        F.lit(0).alias("_kind"),
        F.col(dim_seq).alias("_s"),
        version.alias("_v"),
    )
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in ver.schema}
    row = F.struct(*df.columns)
    ev = df.select(F.col(key).alias("_k"), F.col(ts).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"), nothing["_s"], nothing["_v"], row.alias("_e"))
    both = ev.unionByName(ver.withColumn("_e", F.lit(None).cast(ev.schema["_e"].dataType)))
    order = ["_t", "_kind", "_s"]
    if bucket_ms is None:
        carried = prev_value_by_density(both, ["_k"], order, "_v", "_asof")
    else:
        carried = prev_value(both, ["_k"], order, "_v", "_asof", F.floor(F.unix_millis("_t") / F.lit(bucket_ms)))
    return carried.filter(F.col("_kind") == 1).select("_e.*", F.col("_asof._dim_seq").alias(dim_seq), *[F.col(f"_asof.{c}").alias(c) for c in columns])


def point_lookup(dim: DataFrame, pk: str, value: str, order: str | None = None) -> DataFrame:
    """The dim row of one key: at most one row (the highest ``order`` when
    the snapshot holds several), none when the key is unknown."""
    hit = dim.filter(F.col(pk) == F.lit(value))
    if order is not None:
        hit = hit.orderBy(F.col(order).desc())
    return hit.limit(1)


def first_seen(df: DataFrame, key: str, ts: str, out: str = "start_date") -> DataFrame:
    """Per key, the date of its first record (a partial aggregate)."""
    return df.groupBy(key).agg(F.to_date(F.min(ts)).alias(out))


def working_days(df: DataFrame, key: str, ts: str, start: DataFrame, start_col: str = "start_date") -> DataFrame:
    """Days between the record's date and the key's ``start_date`` row."""
    side = bounded_broadcast(start, DIM_MAX_ROWS, materialize=True)
    joined = df.join(side, on=key, how="left")
    return joined.withColumn(
        "working_days", F.datediff(F.to_date(F.col(ts)), F.col(start_col)).cast("bigint")
    ).drop(start_col)
