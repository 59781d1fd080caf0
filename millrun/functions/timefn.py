"""Time column functions (all JVM-side, codegen friendly).

The source design formats dates in the process default zone; we pin the Spark
session zone (``spark.sql.session.timeZone``, UTC by default) and take it
from there, so a run is reproducible on any machine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds (bigint) -> timestamp (session zone)."""
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def epoch_ms_to_date(c: Column | str) -> Column:
    """Epoch milliseconds -> calendar date in the session zone."""
    return F.to_date(epoch_ms_to_ts(c))


def text_to_ts(c: Column | str) -> Column:
    """Text timestamp -> timestamp. Accepts ISO-like text and epoch-ms
    digits; junk gives NULL (the caller dead-letters it).

    ISO text is tried first: read as a number first, "2024" would become
    two seconds after 1970.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(
        F.try_to_timestamp(c),
        F.when(c.rlike(r"^-?[0-9]{5,}$"), F.timestamp_millis(c.try_cast("bigint"))),
    )


def date_text(c: Column) -> Column:
    """Date or timestamp -> ``yyyy-MM-dd`` text."""
    return F.date_format(c, "yyyy-MM-dd")


def ts_text(c: Column) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss`` text (window bounds wbt/wet)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def ts_to_epoch_ms(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_millis(c.cast("timestamp"))
