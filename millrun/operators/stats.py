"""Size statistics of the DWS layer and equipment up-time.

Three inspection feeds are normalised to one schema of five measures,
unioned, enriched with the production dims, and summed per tumbling
event-time window and (factory, line, process type, equipment, new-size
flag). The window length is not fixed by the source design; it is a
parameter (default 10 seconds, the bench uses days).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrun.functions.timefn import ts_text
from millrun.sources.shapes import MEASURES

# Output dim columns of the statistics (lower case, B24).
DIM_KEYS = ["fid", "lid", "mtype", "eid"]

# Measures per feed, (defect, check, defect kind, re-check,
# re-check fail). Pass means isPass == "1"; NULL counts as a failure.
_FEEDS = {
    "detail": ("fail", 1, 0, 0, 0),
    "per_size": (0, 0, 1, 0, 0),
    "recheck": (0, 0, 0, 1, "fail"),
}


def _failed(is_pass: str) -> Column:
    return F.when(F.col(is_pass) == "1", F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def normalise(
    df: DataFrame,
    feed: str,
    keep: Sequence[str] = ("mid", "size_id", "isNew", "ts"),
    is_pass: str = "isPass",
) -> DataFrame:
    """One inspection feed -> (keep..., feed, five measures)."""
    if feed not in _FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    measures = []
    for name, spec in zip(MEASURES, _FEEDS[feed]):
        val = _failed(is_pass) if spec == "fail" else F.lit(spec).cast("bigint")
        measures.append(val.alias(name))
    return df.select(*keep, F.lit(feed).alias("feed"), *measures)


def normalise_once(
    df: DataFrame,
    member: dict[str, Column],
    keep: Sequence[str] = ("mid", "size_id", "isNew", "ts"),
    is_pass: str = "isPass",
) -> DataFrame:
    """Several feeds that are all parts of ``df``, in one scan: each row is
    given out once per feed whose ``member`` condition holds."""
    unknown = [f for f in member if f not in _FEEDS]
    if unknown:
        raise ValueError(f"unknown feed {unknown[0]!r}")

    def row(feed: str) -> Column:
        fields = [F.lit(feed).alias("feed")]
        for name, spec in zip(MEASURES, _FEEDS[feed]):
            fields.append((_failed(is_pass) if spec == "fail" else F.lit(spec).cast("bigint")).alias(name))
        return F.when(member[feed], F.struct(*fields))

    rows = F.filter(F.array(*[row(feed) for feed in member]), lambda r: r.isNotNull())
    kept = [F.col(c) if isinstance(c, str) else c for c in keep]
    return df.select(*kept, F.inline(rows))


def measures_once(
    df: DataFrame,
    member: dict[str, Column],
    keep: Sequence[str] = ("mid", "size_id", "isNew", "ts"),
    is_pass: str = "isPass",
) -> DataFrame:
    """The sums of ``normalise_once`` without its rows: each row that is in
    some feed once, with its measures added up over the feeds it is in. What
    only sums the measures needs no more."""
    unknown = [f for f in member if f not in _FEEDS]
    if unknown:
        raise ValueError(f"unknown feed {unknown[0]!r}")
    within = {feed: F.coalesce(cond, F.lit(False)) for feed, cond in member.items()}

    def value(i: int) -> Column:
        total = F.lit(0).cast("bigint")
        for feed, cond in within.items():
            spec = _FEEDS[feed][i]
            if spec != 0:
                total = total + F.when(cond, _failed(is_pass) if spec == "fail" else F.lit(spec)).otherwise(F.lit(0)).cast("bigint")
        return total

    any_feed = F.lit(False)
    for cond in within.values():
        any_feed = any_feed | cond
    kept = [F.col(c) if isinstance(c, str) else c for c in keep]
    return df.filter(any_feed).select(*kept, *[value(i).alias(m) for i, m in enumerate(MEASURES)])


def union_feeds(*frames: DataFrame) -> DataFrame:
    """Union keeping duplicates, matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def size_stats(
    df: DataFrame,
    ts: str = "ts",
    window: str = "10 seconds",
    keys: Sequence[str] = (*DIM_KEYS, "isnew"),
) -> DataFrame:
    """Tumbling-window sums of the five measures per ``keys``. Windows
    start at the 1970 epoch; an event on a window end belongs to the next
    window. ``wbt``/``wet`` are the bounds as ``yyyy-MM-dd HH:mm:ss``.

    A stream groups by the window itself (what append mode and the
    watermark need); a batch groups by its bounds, plain timestamps that
    hash faster than the window struct. The end is the window's own: the
    start plus an interval would count calendar days, which differ from
    the window's length where clocks change."""
    sums = [F.sum(m).cast("bigint").alias(m) for m in MEASURES]
    if df.isStreaming:
        agg = df.groupBy(F.window(F.col(ts), window).alias("_w"), *keys).agg(*sums)
        start, end = F.col("_w.start"), F.col("_w.end")
    else:
        whole = F.window(F.col(ts), window)
        agg = df.groupBy(whole.start.alias("_ws"), whole.end.alias("_we"), *keys).agg(*sums)
        start, end = F.col("_ws"), F.col("_we")
    return agg.select(ts_text(start).alias("wbt"), ts_text(end).alias("wet"), *keys, *MEASURES)


def window_start(ts: str, window: str) -> Column:
    """Start of the tumbling window (epoch-aligned) holding ``ts``."""
    return F.window(F.col(ts), window).start


def uptime_sessions(
    beats: DataFrame, key: str, ts: str, gap: str = "6 minutes"
) -> DataFrame:
    """Power-on sessions from heartbeats: a new session starts when a beat
    comes more than ``gap`` after the previous one. Per session: first and
    last beat, number of beats and up-time in microseconds (last - first).

    Time is cut into buckets as wide as the gap. Two beats of a key in one
    bucket are closer than the gap, so a bucket is always one piece of a
    session: a plain partial aggregate (first, last, number), after which a
    busy key is one row per bucket and map task and no beat is shuffled. A
    window over the pieces alone joins those that follow each other within
    the gap. Beats without a key are one group. Streams use
    ``uptime_sessions_stream``.
    """
    gap_us = interval_micros(gap)

    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))

    staged = beats.select(key, ts, F.floor(micros(ts) / F.lit(gap_us)).alias("_b"))
    pieces = staged.groupBy(key, "_b").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    wp = Window.partitionBy(key).orderBy("_b")
    prev_last = F.lag("_last").over(wp)
    starts = F.when(prev_last.isNull() | (micros("_first") - micros(prev_last) > F.lit(gap_us)), 1).otherwise(0)
    numbered = pieces.withColumn("_new", starts).withColumn(
        "_sid", F.sum("_new").over(wp.rowsBetween(Window.unboundedPreceding, 0))
    )
    agg = numbered.groupBy(key, "_sid").agg(
        F.min("_first").alias("first_beat"),
        F.max("_last").alias("last_beat"),
        F.sum("_n").cast("bigint").alias("n_beats"),
    )
    return agg.select(
        key,
        "first_beat",
        "last_beat",
        "n_beats",
        (micros("last_beat") - micros("first_beat")).cast("bigint").alias("uptime_us"),
    )


def uptime_sessions_stream(beats: DataFrame, key: str, ts: str, gap: str = "6 minutes") -> DataFrame:
    """Streaming form: Spark's event-time session window (watermark the
    input first); a session closes once the watermark passes its end."""
    s = beats.groupBy(key, F.session_window(F.col(ts), gap).alias("_s")).agg(
        F.min(ts).alias("first_beat"),
        F.max(ts).alias("last_beat"),
        F.count(F.lit(1)).cast("bigint").alias("n_beats"),
    )
    return s.select(key, "first_beat", "last_beat", "n_beats")


def power_on_sessions(
    logs: DataFrame, key: str, ts: str, seq: str, kind: str, gap: str = "6 minutes", until: str | None = None
) -> DataFrame:
    """Power-on sessions of a machine from all its records.

    A record opens a session if it is the machine's first, a ``start`` record,
    the next after a ``shutdown``, or more than ``gap`` after the one before;
    every other record goes on with it. Per session: first and last record,
    records, up-time in microseconds, what opened it (``start`` or ``record``)
    and what closed it: ``shutdown``, a further ``start``, a ``gap``, or nothing
    yet (``open``; with ``until``, the time up to which records are known, a
    silence of ``gap`` up to then closes it). Records of one instant follow
    ``seq``. Rows without a key are one group.

    Time is cut into buckets as wide as the gap, so that no silence lies within
    a bucket. Its sessions are numbered there by one window per (key, bucket):
    those with a border on both sides inside the bucket are done, and only its
    first and last piece meet their neighbours, in a window over at most two
    rows per bucket. A busy machine is spread over its buckets.
    """
    gap_us = interval_micros(gap)
    known = F.lit(None).cast("long") if until is None else F.unix_micros(F.lit(until).cast("timestamp"))
    staged = logs.select(
        F.col(key).alias("_key"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"),
        F.col(seq).alias("_seq"),
        F.when(F.col(kind) == "start", 1).when(F.col(kind) == "shutdown", 2).otherwise(0).alias("_kind"),
    ).withColumn("_b", F.floor(F.col("_us") / F.lit(gap_us)))
    order = ["_us", "_seq"]
    inside = Window.partitionBy("_key", "_b").orderBy(*order)
    prev = F.lag("_kind").over(inside)
    cut = F.when(prev.isNotNull() & ((F.col("_kind") == 1) | (prev == 2)), 1).otherwise(0)
    numbered = staged.withColumn("_cut", cut).withColumn(
        "_piece", F.sum("_cut").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    place = F.struct(*order)
    pieces = numbered.groupBy("_key", "_b", "_piece").agg(
        F.min("_us").alias("_first"),
        F.max("_us").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_kind", place).alias("_opened"),
        F.max_by("_kind", place).alias("_closed"),
    )
    pieces = pieces.withColumn("_top", F.max("_piece").over(Window.partitionBy("_key", "_b")))
    by_shutdown = F.when(F.col("_closed") == 2, "shutdown")
    done = pieces.filter((F.col("_piece") > 0) & (F.col("_piece") < F.col("_top"))).select(
        "_key", "_first", "_last", "_n", "_opened", F.coalesce(by_shutdown, F.lit("start")).alias("_by")
    )

    rim = Window.partitionBy("_key").orderBy("_b", "_piece")
    before, since = F.lag("_closed").over(rim), F.col("_first") - F.lag("_last").over(rim)
    after = F.lead("_first").over(rim) - F.col("_last")
    opens = (F.col("_piece") > 0) | before.isNull() | (F.col("_opened") == 1) | (before == 2) | (since > gap_us)
    by = (
        F.when(F.col("_closed") == 2, "shutdown")
        .when(F.col("_piece") < F.col("_top"), "start")
        .when(after.isNull(), F.when(F.col("_last") + gap_us <= known, "gap").otherwise("open"))
        .when(after > gap_us, "gap")
        .otherwise("start")
    )
    rims = pieces.filter((F.col("_piece") == 0) | (F.col("_piece") == F.col("_top")))
    marked = rims.withColumn("_by", by).withColumn("_opens", F.when(opens, 1).otherwise(0))
    joined = marked.withColumn("_sid", F.sum("_opens").over(rim.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("_key", "_sid").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_n").alias("_n"),
        F.min_by("_opened", F.struct("_b", "_piece")).alias("_opened"),
        F.max_by("_by", F.struct("_b", "_piece")).alias("_by"),
    )
    return whole.drop("_sid").unionByName(done).select(
        F.col("_key").alias(key),
        F.timestamp_micros("_first").alias("first_record"),
        F.timestamp_micros("_last").alias("last_record"),
        F.col("_n").cast("bigint").alias("n_records"),
        (F.col("_last") - F.col("_first")).alias("uptime_us"),
        F.when(F.col("_opened") == 1, "start").otherwise("record").alias("opened_by"),
        F.col("_by").alias("closed_by"),
    )


def interval_micros(text: str) -> int:
    """Microseconds of a fixed interval such as ``6 minutes``."""
    n, unit = text.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * seconds * 1_000_000


def size_stats_enriched(
    feeds: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, str, dict[str, str]]],
    ts: str = "ts",
    window: str = "10 seconds",
    keys: Sequence[str] = (*DIM_KEYS, "isnew"),
    grain: Sequence[str] = ("mid", "size_id", "isnew"),
    preaggregate: bool = True,
) -> DataFrame:
    """Enrich the unioned feeds with the production dims and roll up.

    ``lookups`` are (dim, feed key, dim key, {dim column: output}). While
    every dim is broadcast (checked), the joins are map-side and the sums
    are one partial aggregate: one shuffle. A dim above the bound must be
    shuffled; then the feeds are first summed per (window, grain) — the dim
    keys are functions of the grain, so the sums are the same — and only
    those rows meet the dims. A streaming run passes ``preaggregate=False``
    (one stateful aggregation per query).
    """
    from millrun.operators.dims import DIM_MAX_ROWS, enrich
    from millrun.operators.keyed import sized

    if preaggregate:
        sides = [dim.select(F.col(k).alias("_dim_key"), *[F.col(c).alias(o) for c, o in cols.items()]) for dim, _, k, cols in lookups]
        preaggregate = not all(sized(side, DIM_MAX_ROWS)[1] for side in sides)

    base = feeds
    if preaggregate:
        base = feeds.groupBy(window_start(ts, window).alias(ts), *grain).agg(
            *[F.sum(m).cast("bigint").alias(m) for m in MEASURES]
        )
    for dim, left_key, dim_key, cols in lookups:
        base = enrich(base, dim, left_key, dim_key, cols)
    return size_stats(base, ts, window, keys)
