"""Per-key stateful operators for streams (``applyInPandasWithState``).

The batch forms (``millrun.operators.parts`` / ``inspect``) are aggregates
and windows; Structured Streaming refuses those shapes (a window function,
or an aggregate joined back to its own input), so the streaming forms keep
a small state per key instead:

* new-part flag: the part's first "new" day (never expires);
* unique part per day: the part's last day and the time of its last
  write, expiring one day (processing time) after that write;
* re-check feed: whether the (production id, size) was seen.

Order. These operators depend on arrival order (``seq``). Spark hands a
key's rows of one micro-batch to Python as an iterator of Arrow chunks in
no promised order (and refuses a sort on a stream), so each function
gathers the key's rows *of the current micro-batch*, sorts them by
``seq``, decides vectorised, and emits in slices. The memory one key can
take is therefore bounded by the micro-batch size: cap it with
``maxOffsetsPerTrigger`` (queue) or ``maxFilesPerTrigger`` (files). The
state itself is one small row per key (a RocksDB-backed state store keeps
large key counts off the heap).

Rows carrying a ``dead_reason`` pass through untouched and never change
the state, so one query can feed both the output and the dead letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY_MS = 24 * 3600 * 1000
SLICE_ROWS = 10_000


def _gather(chunks: Iterator[pd.DataFrame], seq: str) -> pd.DataFrame:
    """This micro-batch's rows of one key, sorted by arrival order."""
    parts = [c for c in chunks if len(c)]
    if not parts:
        return pd.DataFrame()
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return pdf.sort_values(seq, kind="stable", na_position="first").reset_index(drop=True)


def _slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for i in range(0, len(pdf), SLICE_ROWS):
        yield pdf.iloc[i : i + SLICE_ROWS]


def _live(pdf: pd.DataFrame, dead: str | None) -> pd.Series:
    """Rows that take part (dead-letter rows pass through untouched)."""
    if dead is None or dead not in pdf.columns:
        return pd.Series(True, index=pdf.index)
    return pdf[dead].isna()


# ------------------------------------------------------------ new-part flag


def _flag_fn(seq: str, is_new: str, day: str, dead: str | None):
    def fn(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first = state.get[0] if state.exists else None
        pdf = _gather(chunks, seq)
        if len(pdf) == 0:
            return
        is1 = (pdf[is_new] == "1") & _live(pdf, dead)
        if first is None and is1.any():
            first = pdf.loc[is1.idxmax(), day]
            state.update((first,))
        if first is not None:
            pdf.loc[is1 & (pdf[day] != first), is_new] = "0"
        yield from _slices(pdf)

    return fn


def new_part_flag_stream(
    df: DataFrame,
    part: str = "part_id",
    is_new: str = "is_new",
    day: str = "log_day",
    seq: str = "seq",
    dead: str | None = "dead_reason",
) -> DataFrame:
    """Streaming new-part flag; ``day`` is the record's ``yyyy-MM-dd``."""
    return df.groupBy(part).applyInPandasWithState(
        _flag_fn(seq, is_new, day, dead),
        outputStructType=df.schema,
        stateStructType="first_day string",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )


# ------------------------------------------------------ unique part per day


def _unique_fn(seq: str, day: str, ttl_ms: int, dead: str | None, cleanup: bool):
    def fn(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        last, last_write = state.get if state.exists else (None, None)
        if last_write is not None and now - last_write >= ttl_ms:
            last = None  # expired: never returned
        pdf = _gather(chunks, seq)
        if len(pdf) == 0:
            return
        live = _live(pdf, dead)
        if not live.all():
            yield pdf[~live]
            pdf = pdf[live].reset_index(drop=True)
        if len(pdf):
            days = pdf[day]
            prev = days.shift(1)
            prev.iloc[0] = last
            keep = days.isna() | (days != prev)
            if keep.any():
                last_write = now
            last = days.iloc[-1]
            yield from _slices(pdf[keep])
        state.update((last, last_write))
        if cleanup:
            state.setTimeoutDuration(ttl_ms)

    return fn


def unique_part_stream(
    df: DataFrame,
    part: str = "part_id",
    day: str = "mday",
    seq: str = "seq",
    ttl_ms: int = DAY_MS,
    dead: str | None = "dead_reason",
    cleanup: bool = True,
) -> DataFrame:
    """Streaming first-record-of-the-day filter (``mode="change"``): a
    record passes when its day differs from the part's previous record;
    the remembered day expires ``ttl_ms`` (processing time) after it was
    last written — checked on every access.

    ``cleanup`` also drops the state of keys idle for ``ttl_ms`` (a
    processing-time timeout). Spark then plans a state-cleanup batch on
    every trigger, so such a query never reports "caught up": use it for
    continuously running jobs, and ``cleanup=False`` for catch-up runs
    (``availableNow``) and tests.
    """
    return df.groupBy(part).applyInPandasWithState(
        _unique_fn(seq, day, ttl_ms, dead, cleanup),
        outputStructType=df.schema,
        stateStructType="last_day string, last_write long",
        outputMode="append",
        timeoutConf=GroupStateTimeout.ProcessingTimeTimeout if cleanup else GroupStateTimeout.NoTimeout,
    )


def unique_part_distinct_stream(
    df: DataFrame, part: str = "part_id", day_ts: str = "mts", delay: str = "1 day"
) -> DataFrame:
    """Built-in distinct form: one record per (part, day) within the
    watermark. ``day_ts`` is an event-time timestamp column."""
    return (
        df.withWatermark(day_ts, delay)
        .withColumn("_day", F.to_date(day_ts))
        .dropDuplicatesWithinWatermark([part, "_day"])
        .drop("_day")
    )


def daily_part_count_stream(
    df: DataFrame, part: str = "part_id", day_ts: str = "mts", delay: str = "1 day"
) -> DataFrame:
    """Different parts per day on a stream (append mode): the built-in
    dedupe within the watermark, then a one-day window count; a day is
    emitted once the watermark passes its end."""
    first = unique_part_distinct_stream(df, part, day_ts, delay)
    return first.groupBy(F.window(day_ts, "1 day").alias("_w")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_parts")
    ).select(F.to_date(F.col("_w.start")).alias("mdate"), "n_parts")


def first_defect_stream(
    details: DataFrame,
    mid: str = "mid",
    size_id: str = "size_id",
    is_pass: str = "isPass",
    event_ts: str = "ets",
    delay: str = "1 day",
) -> DataFrame:
    """Streaming "independent size" feed: the first defective detail per
    (production id, size, day), kept by the built-in dedupe within the
    watermark (a defect arriving more than ``delay`` late may be dropped
    as late, never duplicated)."""
    defects = details.filter(~F.coalesce(F.col(is_pass) == "1", F.lit(False)))
    return (
        defects.withWatermark(event_ts, delay)
        .withColumn("_day", F.to_date(event_ts))
        .dropDuplicatesWithinWatermark([mid, size_id, "_day"])
        .drop("_day")
    )


# ------------------------------------------------------------ re-check feed


def _recheck_fn(seq: str):
    def fn(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _gather(chunks, seq)
        if len(pdf) == 0:
            return
        if not state.exists:
            state.update((True,))
            pdf = pdf.iloc[1:]
        yield from _slices(pdf)

    return fn


def recheck_stream(df: DataFrame, key: list[str] | None = None, seq: str = "seq") -> DataFrame:
    """Streaming re-check feed: every detail of a (production id, size)
    after its first one."""
    key = key or ["mid", "size_id"]
    return df.groupBy(*key).applyInPandasWithState(
        _recheck_fn(seq),
        outputStructType=df.schema,
        stateStructType="seen boolean",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
