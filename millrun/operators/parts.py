"""Part-level operators of the DWD/DWM layers (batch form).

* ``new_part_flag`` — the machine's "is_new" flag corrected per part: the
  first record claiming a new part fixes that part's first production day;
  later "new" claims on any *other* day become "0". Records saying "0"
  never set the day.
* ``unique_part_per_day`` — first record of a part per day:
  ``mode="change"`` passes a record whenever its day differs from the
  previous record of the part (d1, d2, d1 passes three times);
  ``mode="distinct"`` passes one record per (part, day).
* ``daily_part_count`` and ``part_stats`` — roll-ups of the two above.
* ``daily_part_sketches`` / ``period_parts`` — mergeable distinct counts: a
  sketch per day is stored, and weeks and months come from the sketches.
* ``completion_progress`` — steps of a large part done by each day, as bit
  masks.

Arrival order is an explicit ``seq`` column (Kafka partition offset, event
id, ...). The streaming forms live in ``millrun.streaming.stateful``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrun.operators.keyed import first_per_key, prev_value, prev_value_by_density, sized


def first_new_day(df: DataFrame, part: str, is_new: str, day: str, seq: str) -> DataFrame:
    """(part, first_new_day): day of the earliest record (by seq) whose
    flag is "1". A partial aggregate — one row per part per map task."""
    return (
        df.filter((F.col(is_new) == "1") & F.col(part).isNotNull())
        .groupBy(part)
        .agg(F.min_by(day, seq).alias("_first_new_day"))  # fixed-width values: a hash aggregate
    )


def new_part_flag(
    df: DataFrame,
    part: str = "part_id",
    is_new: str = "is_new",
    day: str = "log_date",
    seq: str = "seq",
) -> DataFrame:
    """Return ``df`` with ``is_new`` corrected (string "0"/"1" kept).

    The first-new-day table (one row per part) is broadcast when it is
    under the bound: a map-only pass. Above it, only the rows that claim
    "1" — the only ones that can change — are shuffled to meet it; the
    rest pass through untouched."""
    first, fits = sized(first_new_day(df, part, is_new, day, seq), materialize=True)
    claims = F.coalesce(F.col(is_new) == "1", F.lit(False))

    def correct(rows: DataFrame, side: DataFrame) -> DataFrame:
        fixed = F.when(claims & (F.col(day) != F.col("_first_new_day")), F.lit("0")).otherwise(F.col(is_new))
        return rows.join(side, on=part, how="left").withColumn(is_new, fixed).drop("_first_new_day")

    if fits:
        return correct(df, F.broadcast(first))
    return df.filter(~claims).unionByName(correct(df.filter(claims), first))


def unique_part_per_day(
    df: DataFrame,
    part: str = "part_id",
    day: str = "mdate",
    seq: str = "seq",
    mode: str = "change",
    seq_bucket: int | None = None,
) -> DataFrame:
    """``mode="change"``: ``seq`` may be a number or the queue's order of
    arrival (text). Parts with very many rows are cut by density
    (``prev_value_by_density``); ``seq_bucket`` instead cuts a numeric
    ``seq`` in buckets of a fixed width."""
    if mode == "distinct":
        payload = [c for c in df.columns if c not in (part, day, seq)]
        return first_per_key(df, [part, day], [seq], payload).select(*df.columns)
    if mode != "change":
        raise ValueError(f"mode must be 'change' or 'distinct', not {mode!r}")
    if seq_bucket is None:
        with_prev = prev_value_by_density(df, [part], [seq], day, "_prev_day")
    else:
        with_prev = prev_value(df, [part], [seq], day, "_prev_day", F.floor(F.col(seq) / F.lit(seq_bucket)))
    keep = F.col("_prev_day").isNull() | (F.col("_prev_day") != F.col(day))
    return with_prev.filter(keep).drop("_prev_day")


def daily_part_count(df: DataFrame, part: str = "part_id", day: str = "mdate") -> DataFrame:
    """Number of different parts per day. ``count(distinct)`` is planned as
    a two-level aggregate (by (day, part), then by day), so no task sees
    all rows of a day."""
    return df.groupBy(day).agg(F.countDistinct(part).cast("bigint").alias("n_parts"))


def part_stats(
    flagged: DataFrame, part: str = "part_id", day: str = "log_date", is_new: str = "is_new"
) -> DataFrame:
    """Per part and day: records, records of a new part, reworked records."""
    return flagged.groupBy(part, day).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_records"),
        F.sum(F.when(F.col(is_new) == "1", 1).otherwise(0)).cast("bigint").alias("n_new"),
        F.sum(F.when(F.col(is_new) == "0", 1).otherwise(0)).cast("bigint").alias("n_rework"),
    )


# ------------------------------------------------- mergeable distinct counts

# log2 of a sketch's registers: a relative standard error of 1.04 / sqrt(2 ** LG_K).
LG_K = 14


def sketch_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that an estimate stays within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_part_sketches(df: DataFrame, part: str = "part_id", day: str = "mdate", lg_k: int = LG_K) -> DataFrame:
    """(day, n_records, sketch): the different parts of a day as a sketch of
    at most about 2 ** lg_k bytes. Sketches are built map-side and merged, so a day's
    rows are not shuffled. Parts without a value are not counted."""
    return df.groupBy(day).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_records"), F.hll_sketch_agg(F.col(part).cast("string"), lg_k).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, day: str = "mdate") -> DataFrame:
    """One row per day from any number of partial ones (of batches, of streams)."""
    return sketches.groupBy(day).agg(
        F.sum("n_records").cast("bigint").alias("n_records"), F.hll_union_agg("sketch").alias("sketch")
    )


def period_parts(sketches: DataFrame, day: str = "mdate", periods: Sequence[str] = ("day", "week", "month")) -> DataFrame:
    """(period, start, n_records, n_estimate): different parts of each day,
    week (from Monday) and month, from the daily sketches alone."""
    levels = F.explode(F.array(*[F.struct(F.lit(p).alias("period"), F.trunc(day, p).alias("start")) if p != "day"
                                 else F.struct(F.lit("day").alias("period"), F.col(day).alias("start")) for p in periods]))
    spread = sketches.select("n_records", "sketch", levels.alias("_l"))
    return spread.groupBy(F.col("_l.period").alias("period"), F.col("_l.start").alias("start")).agg(
        F.sum("n_records").cast("bigint").alias("n_records"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias("n_estimate"),
    )


def checked_period_parts(df: DataFrame, sketches: DataFrame, part: str = "part_id", day: str = "mdate", lg_k: int = LG_K) -> DataFrame:
    """``period_parts`` next to the exact counts of the rows ``df`` (one pass
    over its different (part, day) pairs), and whether the estimate is
    within ``sketch_error``: the audit of stored sketches."""
    days = df.filter(F.col(part).isNotNull()).select(part, day).distinct()
    levels = F.explode(F.array(*[F.struct(F.lit(p).alias("period"), (F.col(day) if p == "day" else F.trunc(day, p)).alias("start"))
                                 for p in ("day", "week", "month")]))
    pairs = days.select(part, levels.alias("_l")).select(part, "_l.*")
    exact = pairs.groupBy("period", "start").agg(F.countDistinct(part).cast("bigint").alias("n_parts"))
    joined = period_parts(sketches, day).join(exact, ["period", "start"], "left")
    n = F.coalesce("n_parts", F.lit(0).cast("bigint"))
    within = F.abs(F.col("n_estimate") - n) <= n * sketch_error(lg_k)
    return joined.select("period", "start", "n_records", n.alias("n_parts"), "n_estimate", within.alias("within_bound"))


# ------------------------------------------------------- completion progress

_WORD = 64


def _step_words(step: str, steps: int) -> list[Column]:
    """Per word of 64 steps, the bit of the row's step."""
    n, one, none = F.col(step).cast("long"), F.lit(1).cast("long"), F.lit(0).cast("long")
    real = n.between(1, steps)
    return [
        F.bit_or(F.when(real & (F.floor((n - 1) / _WORD) == w), F.call_function("shiftleft", one, F.pmod(n - 1, F.lit(_WORD)).cast("int"))).otherwise(none))
        for w in range(-(-steps // _WORD))
    ]


def _done(masks: Column) -> Column:
    return F.aggregate(masks, F.lit(0), lambda n, w: n + F.bit_count(w)).cast("bigint")


def _missing(masks: Column, planned: Column) -> Column:
    bit = lambda s: F.getbit(F.element_at(masks, (F.floor((s - 1) / _WORD) + 1).cast("int")), F.pmod(s - 1, F.lit(_WORD)))
    return F.filter(F.when(planned > 0, F.sequence(F.lit(1), planned)).otherwise(F.array().cast("array<int>")), lambda s: bit(s) == 0)


def step_masks(df: DataFrame, part: str, day: str, step: str, steps: int) -> DataFrame:
    """(part, day, n_records, masks): the steps recorded on a day as one bit
    each, in words of 64. The words are or-ed map-side, so a part with very
    many records costs a row per day and task; masks of batches merge the
    same way (``merge_masks``). Steps outside 1..``steps`` set no bit."""
    words = _step_words(step, steps)
    agg = df.groupBy(part, day).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"), *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    return agg.select(part, day, "n_records", F.array(*[f"_w{i}" for i in range(len(words))]).alias("masks"))


def merge_masks(masks: DataFrame, part: str, day: str, steps: int) -> DataFrame:
    """One row per part and day from any number of partial ones."""
    n = -(-steps // _WORD)
    agg = masks.groupBy(part, day).agg(
        F.sum("n_records").cast("bigint").alias("n_records"), *[F.bit_or(F.col("masks")[i]).alias(f"_w{i}") for i in range(n)]
    )
    return agg.select(part, day, "n_records", F.array(*[f"_w{i}" for i in range(n)]).alias("masks"))


def completion_progress(masks: DataFrame, part: str, day: str, steps: int, planned: Column | None = None) -> DataFrame:
    """Per part and day with records: the steps done up to then (``n_done``),
    those done that day for the first time (``n_new``), ``progress`` of the
    planned steps (``planned``, at most ``steps``, which is the default), and
    the numbers of the planned steps still ``missing``. The window per part
    sees one row a day."""
    n = -(-steps // _WORD)
    plan = F.lit(steps) if planned is None else F.least(planned.cast("int"), F.lit(steps))
    upto = Window.partitionBy(part).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.array(*[F.bit_or(F.col("masks")[i]).over(upto) for i in range(n)])
    staged = masks.select(part, day, "n_records", so_far.alias("_sum"), plan.alias("n_planned"))
    counted = staged.withColumn("n_done", _done(F.col("_sum")))
    last = F.lag("n_done").over(Window.partitionBy(part).orderBy(day))
    return counted.select(
        part,
        day,
        "n_records",
        (F.col("n_done") - F.coalesce(last, F.lit(0))).cast("bigint").alias("n_new"),
        "n_done",
        "n_planned",
        _missing(F.col("_sum"), F.col("n_planned")).alias("missing"),
    ).withColumn("progress", F.when(F.col("n_planned") > 0, (F.col("n_planned") - F.size("missing")) / F.col("n_planned")))


def completion_stream(df: DataFrame, part: str, step: str, steps: int) -> DataFrame:
    """Streaming form (update mode): the present progress of each part that
    a micro-batch touches. State is one mask per part."""
    words = _step_words(step, steps)
    agg = df.groupBy(part).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"), *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    masks = F.array(*[f"_w{i}" for i in range(len(words))])
    return agg.select(part, "n_records", _done(masks).alias("n_done"), _missing(masks, F.lit(steps)).alias("missing"))
