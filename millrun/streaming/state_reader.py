"""The keyed state of a stream, read from its checkpoint as a table.

Spark's ``statestore`` source reads the snapshot of one committed batch; the
stream need not run. So the state of a stopped or restarted query can be
audited: ``state_differences`` holds it against what a batch job says of the
same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def keyed_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator_id: int = 0) -> DataFrame:
    """One row per key of an ``applyInPandasWithState`` operator: the key's
    columns and the state's, after the last committed batch or ``batch_id``.
    Names that both have must not occur. A checkpoint without a committed
    batch is an error of the source."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    stored = reader.load(checkpoint).where(F.col("value.groupState").isNotNull())
    return stored.select("key.*", "value.groupState.*")


def state_differences(state: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, state, expected): the keys whose state is not what is expected
    (NULL-safe), with the side that lacks a key as NULL. Both sides have one
    row per key; one shuffle join on the keys, NULL keys included."""
    side = lambda df, name: df.select(*keys, F.struct(*columns).alias(name))
    a, b = side(state, "state").alias("a"), side(expected, "expected").alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    both = a.join(b, same, "full_outer").where(~F.col("state").eqNullSafe(F.col("expected")))
    return both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], "state", "expected")
