"""Helpers shared by the operators: table access, shared scratch tables, bounded memos."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrun.session import checkpoint_dir


#: Once a table is written, its job's shuffle files are of no use any more.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Texts may be long, so few rows and few bytes travel to a Python worker at
#: once: (setting, Spark's default, ours). A submit that says otherwise holds.
_BATCHES = [
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"),
]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    _small_batches(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _small_batches(spark: SparkSession) -> None:
    for setting, default, ours in _BATCHES:
        if spark.conf.get(setting, default) == default:
            spark.conf.set(setting, ours)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``."""
    _small_batches(spark)
    return f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: the lineage
    is cut, and a lost executor costs no recomputation of what stands before."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    kept = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, kept)
    return spark.read.schema(df.schema).parquet(path)


class Memo(dict):
    """``make(key)`` remembered for at most about ``2 * limit`` keys.

    When the young generation is full it becomes the old one; what is asked
    for again moves back, so frequent keys stay and memory is bounded. Keys
    above ``longest`` characters are not kept.
    """

    def __init__(self, make: Callable, limit: int = 200_000, longest: int = 48) -> None:
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        self.remember(key, value)
        return value

    def remember(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


def uncollected(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` with the cyclic collector at rest: it would walk the memos over
    and over, and encoding leaves it nothing to collect."""

    def wrapped(batches: Iterator) -> Iterator:
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()

    return wrapped


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch one by one (texts become Python objects one at a time)."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def emit(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_of(text: str = "text") -> F.Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))
