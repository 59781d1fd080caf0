"""Chained roll-ups of the size statistics: short windows to longer ones, and
equipment to process, line, factory and all.

Every step sums the rows of the step below, not the feeds again: the feeds are
scanned once, and what is shuffled shrinks with each period. The code is the same
in batch and in a stream, where a period's closed windows are the rows of the
next one (``window_time``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrun.functions.timefn import ts_text
from millrun.operators.dims import enrich
from millrun.operators.keyed import written
from millrun.operators.stats import DIM_KEYS, interval_micros
from millrun.sources.shapes import MEASURES

#: Level names by the number of ``DIM_KEYS`` that a row keeps.
LEVELS = ("all", "factory", "line", "process", "equipment")


def _sums() -> list[Column]:
    return [F.sum(m).cast("bigint").alias(m) for m in MEASURES]


def chained_sums(
    rows: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, str, dict[str, str]]],
    ts: str = "ts",
    periods: Sequence[str] = ("10 seconds", "1 hour", "1 day"),
    grain: Sequence[str] = ("mid", "size_id"),
) -> list[DataFrame]:
    """(_w, ``DIM_KEYS``, measures) of each period after the first.

    ``rows`` are measured feed rows; they are summed per (first period,
    ``grain``), those sums meet the dims of ``lookups`` (as in
    ``size_stats_enriched``), and each later period is summed from the one
    before, whose length must divide it. A row without a time is in no
    window; a key that a dim lacks is NULL. In batch the sums of a period that
    has a next one are written once.
    """
    lengths = [interval_micros(p) for p in periods]
    if len(periods) < 2 or any(b % a for a, b in zip(lengths, lengths[1:])):
        raise ValueError(f"each of {list(periods)} must be a multiple of the one before")
    level = rows.groupBy(F.window(ts, periods[0]).alias("_w"), *grain).agg(*_sums())
    for dim, left_key, dim_key, cols in lookups:
        level = enrich(level, dim, left_key, dim_key, cols)
    out = []
    for period in periods[1:]:
        level = level.groupBy(F.window(F.window_time("_w"), period).alias("_w"), *DIM_KEYS).agg(*_sums())
        if not level.isStreaming and period != periods[-1]:
            level = written(level, "period")  # the next period and this one's levels start from it
        out.append(level)
    return out


def by_level(sums: DataFrame, period: str) -> DataFrame:
    """One period of ``chained_sums`` at every level of the hierarchy, from its
    equipment rows; ``level`` tells a NULL key of a dim from one summed over."""
    at = F.explode(F.array(*[F.lit(i) for i in range(len(LEVELS))])).alias("_depth")
    each = sums.select("_w", at, *DIM_KEYS, *MEASURES)
    each = each.select("_w", "_depth", *[F.when(F.col("_depth") > i, F.col(k)).alias(k) for i, k in enumerate(DIM_KEYS)], *MEASURES)
    summed = each.groupBy("_w", "_depth", *DIM_KEYS).agg(*_sums())
    name = F.element_at(F.array(*[F.lit(n) for n in LEVELS]), F.col("_depth") + 1)
    return summed.select(F.lit(period).alias("period"), ts_text(F.col("_w.start")).alias("wbt"), ts_text(F.col("_w.end")).alias("wet"), name.alias("level"), *DIM_KEYS, *MEASURES)
