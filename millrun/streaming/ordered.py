"""Event-time order on a stream, and two operators that need it.

A stream brings a key's records in any order. ``in_event_order`` holds each
record back until the watermark has passed its event time, so that whatever
belongs before it has come (or is late, and dropped and counted by Spark), and
hands a key's records in order to a small state machine:

* ``enrich_asof_stream``, a temporal join: the dim version valid at a fact's
  event time, whichever of the two came first;
* ``power_on_sessions_stream``: power-on sessions delimited by start and
  shutdown records and by silence.

State of a key: the records above the watermark (as many as the delay admits)
and the machine's own few values. Event-time timeouts release the records of
keys that get no more input. Feeds joined here each have a watermark of their
own; Spark takes the least (``spark.sql.streaming.multipleWatermarkPolicy``,
``min`` by default), so that a slow feed holds the others' records back and
loses none. A feed that may fall silent must send ticks (records of a null key):
without them nothing is released.

Event times must lie after 1970 and not be null (such records are dead letters
of the parsing step). Records travel as JSON text within the keyed
step, as a null turns whole columns of longs into doubles there.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrun.operators.stats import interval_micros

SLICE_ROWS = 10_000
NULL_SLOTS = 1_024
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_ORDER = ["_us", "_rank", "_seq"]


class Machine:
    """What one key remembers. ``saved`` is JSON-able, None when nothing is kept."""

    def __init__(self, saved) -> None:
        self.saved = saved

    def take(self, rows: pd.DataFrame) -> list[tuple]:
        """Output for records in order, all of them at or before the watermark."""
        raise NotImplementedError

    def passed(self, mark: int) -> list[tuple]:
        """Output because the watermark (microseconds) has come to ``mark``."""
        return []

    def deadline(self) -> int | None:
        """The watermark at which ``passed`` has something to do."""
        return None


def _packed(rows: pd.DataFrame) -> bytes | None:
    if not len(rows):
        return None
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue()


def _unpacked(held: bytes | None) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(held).read_all().to_pandas()] if held else []


def _step(make: Callable[[object], Machine], columns: Sequence[str]):
    def fn(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, saved = state.get if state.exists else (None, None)
        machine = make(json.loads(saved) if saved else None)
        mark_ms = state.getCurrentWatermarkMs()
        parts = _unpacked(held) + [c for c in chunks if len(c)]
        rows = pd.concat(parts, ignore_index=True).sort_values(_ORDER, kind="stable") if parts else pd.DataFrame({"_us": []})
        ready = rows["_us"] <= mark_ms * 1000
        out = (machine.take(rows[ready]) if ready.any() else []) + machine.passed(mark_ms * 1000)
        rest = rows[~ready]
        due = [int(rest["_us"].iloc[0])] if len(rest) else []
        due += [d for d in [machine.deadline()] if d is not None]
        if len(rest) or machine.saved is not None:
            state.update((_packed(rest), None if machine.saved is None else json.dumps(machine.saved)))
            if due:  # fires once the watermark is above it, in whole milliseconds
                state.setTimeoutTimestamp(max(-(-min(due) // 1000) - 1, mark_ms + 1))
        elif state.exists:
            state.remove()
        for at in range(0, len(out), SLICE_ROWS):
            yield pd.DataFrame(out[at : at + SLICE_ROWS], columns=list(columns))

    return fn


def in_event_order(rows: DataFrame, keys: Sequence[str], make: Callable[[object], Machine], out: str) -> DataFrame:
    """``rows`` (watermarked; ``_us`` event time in microseconds, ``_rank`` and ``_seq`` the order at
    one instant, none of them null) through one machine per key; ``out`` is the DDL of what it gives."""
    schema = T.StructType.fromDDL(out)
    return rows.groupBy(*keys).applyInPandasWithState(
        _step(make, schema.names),
        outputStructType=schema,
        stateStructType="held binary, saved string",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _upward(ts: Column) -> Column:
    """The event time in whole milliseconds, as watermarks are, rounded up: the
    last record of a feed is then not above the watermark that it makes."""
    return F.timestamp_millis(F.ceil(_micros(ts) / 1_000))


# ------------------------------------------------------------ temporal join


class _Versions(Machine):
    """The dim version in force; facts pass with it."""

    def take(self, rows: pd.DataFrame) -> list[tuple]:
        out = []
        for rank, row in zip(rows["_rank"].tolist(), rows["_row"].tolist(), strict=True):
            if rank == 0:
                self.saved = row
            else:
                out.append((row, self.saved))
        return out


def enrich_asof_stream(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    ts: str,
    dim_key: str,
    dim_ts: str,
    dim_seq: str,
    columns: Sequence[str],
    delay: str = "2 seconds",
    dim_delay: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Streaming ``dims.enrich_asof``: a fact gets the dim version with the latest (dim_ts, dim_seq)
    not after its ``ts``; a null or unknown key gets nulls. A fact is given out once both feeds'
    watermarks have passed it. ``salts`` deals a hot key's facts over so many groups, to each of
    which its dim changes are copied; facts without a key are always dealt out."""
    text = dict(changes.dtypes)[dim_seq] == "string"
    first = F.lit("") if text else F.lit(-(1 << 63)).cast("long")
    version = T.StructType([f for f in changes.select(dim_seq, *columns).schema])
    row = F.to_json(F.struct(*facts.columns), _JSON)
    slots = F.when(F.col(key).isNull(), NULL_SLOTS).otherwise(salts)
    fact = facts.select(
        _upward(F.col(ts)).alias("_at"),
        F.col(key).cast("string").alias("_key"),
        F.pmod(F.xxhash64(row), slots).cast("int").alias("_slot"),
        _micros(F.col(ts)).alias("_us"),
        F.lit(1).alias("_rank"),
        first.alias("_seq"),
        row.alias("_row"),
    ).withWatermark("_at", delay)
    seq = F.coalesce(F.col(dim_seq) if text else F.col(dim_seq).cast("long"), first)
    change = changes.select(
        _upward(F.col(dim_ts)).alias("_at"),
        F.col(dim_key).cast("string").alias("_key"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_slot"),
        _micros(F.col(dim_ts)).alias("_us"),
        F.lit(0).alias("_rank"),
        seq.alias("_seq"),
        F.to_json(F.struct(dim_seq, *columns), _JSON).alias("_row"),
    ).withWatermark("_at", dim_delay or delay)
    # ticks have moved the watermark and go no further; as the condition names the
    # event time, it stays above the watermark
    change = change.filter(F.col("_key").isNotNull() | F.col("_at").isNull())
    both = fact.unionByName(change)
    joined = in_event_order(both, ["_key", "_slot"], _Versions, "_row string, _version string")
    parsed = joined.select(F.from_json("_row", facts.schema, _JSON).alias("f"), F.from_json("_version", version, _JSON).alias("v"))
    return parsed.select("f.*", F.col(f"v.{dim_seq}").alias(dim_seq), *[F.col(f"v.{c}").alias(c) for c in columns])


# --------------------------------------------------------- power-on sessions


class _PowerOn(Machine):
    """The running session of a machine: [first, last, records, opened by]."""

    gap = 0

    def take(self, rows: pd.DataFrame) -> list[tuple]:
        out = []
        for us, kind in zip(rows["_us"].tolist(), rows["_kind"].tolist(), strict=True):
            out += self.passed(us - 1)
            if self.saved is not None and kind == 1:
                out.append(self._closed("start"))
            if self.saved is None:
                self.saved = [us, us, 0, "start" if kind == 1 else "record"]
            self.saved[1], self.saved[2] = us, self.saved[2] + 1
            if kind == 2:
                out.append(self._closed("shutdown"))
        return out

    def _closed(self, by: str) -> tuple:
        first, last, n, opened = self.saved
        self.saved = None
        return first, last, n, opened, by

    def passed(self, mark: int) -> list[tuple]:
        return [self._closed("gap")] if self.saved is not None and mark >= self.deadline() else []

    def deadline(self) -> int | None:
        return None if self.saved is None else self.saved[1] + self.gap


def power_on_sessions_stream(logs: DataFrame, key: str, ts: str, seq: str, kind: str, gap: str = "6 minutes", delay: str = "2 seconds") -> DataFrame:
    """Streaming ``stats.power_on_sessions``: a session is given out once it is closed (a silence
    closes it when the watermark is ``gap`` past its last record); an open one is state only."""
    gap_us = interval_micros(gap)

    class Sessions(_PowerOn):
        gap = gap_us

    rows = logs.select(
        F.col(key).alias("_key"),
        _upward(F.col(ts)).alias("_at"),
        _micros(F.col(ts)).alias("_us"),
        F.lit(0).alias("_rank"),
        F.col(seq).alias("_seq"),
        F.when(F.col(kind) == "start", 1).when(F.col(kind) == "shutdown", 2).otherwise(0).alias("_kind"),
    ).withWatermark("_at", delay)
    key_type = dict(rows.dtypes)["_key"]
    keyed = rows.groupBy("_key").applyInPandasWithState(
        _keyed(_step(Sessions, ["first", "last", "n", "opened_by", "closed_by"])),
        outputStructType=f"_key {key_type}, first long, last long, n long, opened_by string, closed_by string",
        stateStructType="held binary, saved string",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return keyed.select(
        F.col("_key").alias(key),
        F.timestamp_micros("first").alias("first_record"),
        F.timestamp_micros("last").alias("last_record"),
        F.col("n").alias("n_records"),
        (F.col("last") - F.col("first")).alias("uptime_us"),
        "opened_by",
        "closed_by",
    )


def _keyed(step):
    """``step`` with the key as the first column of what it gives."""

    def fn(key, chunks, state):
        for out in step(key, chunks, state):
            out.insert(0, "_key", key[0])
            yield out

    return fn
