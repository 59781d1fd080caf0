"""Stream sources and sinks.

* Message-queue text source: ``value`` as string plus ``seq``, the order
  of arrival as text that sorts by (queue time, partition, offset): offsets
  of different partitions say nothing of each other, and a part's records
  may lie in several — needs the Kafka connector on the class path.
  Micro-batches are capped (``maxOffsetsPerTrigger``, 5M records by
  default): the per-key stateful steps hold at most one micro-batch of a
  key in memory.
* File text/JSON sources for tests and replays.
* Sinks: message queue (topic fixed or per record), files, console, and
  ``fan_out`` — one ``foreachBatch`` writer for several outputs of one
  micro-batch, idempotent per batch id.

Checkpoints live under the session's shared checkpoint folder unless a
path is given.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrun.session import checkpoint_dir


#: Files in one micro-batch at most, so that no key gathers a whole backlog.
MAX_FILES = 1_000


def kafka_text_source(
    spark: SparkSession,
    topic: str,
    bootstrap: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = 5_000_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(
        F.col("value").cast("string").alias("value"),
        arrival(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("seq"),
        F.col("partition").alias("kafka_partition"),
    )


def arrival(timestamp: Column, partition: Column, offset: Column) -> Column:
    """Text that sorts as (timestamp, partition, offset)."""
    return F.format_string("%020d-%010d-%020d", F.unix_micros(timestamp), partition.cast("long"), offset.cast("long"))


def file_text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    """Text lines; the records carry their own ``seq`` (one without it is a dead letter)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def file_json_source(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    r = spark.readStream.schema(schema).format("json")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def checkpoint_for(spark: SparkSession, name: str, location: str | None = None) -> str:
    return location or f"{checkpoint_dir(spark)}/streams/{name}"


def _trigger(w: DataStreamWriter, trigger: Mapping[str, object] | None) -> DataStreamWriter:
    return w.trigger(**(trigger or {"processingTime": "5 seconds"}))


def kafka_sink(
    df: DataFrame,
    name: str,
    bootstrap: str,
    topic: str | None = None,
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
):
    """Write ``value`` (and ``topic`` when no fixed topic is given) to the
    queue. Spark's queue sink is at-least-once: consumers dedupe on
    (topic, seq)."""
    w = df.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic:
        w = w.option("topic", topic)
    w = w.option("checkpointLocation", checkpoint_for(df.sparkSession, name, checkpoint)).queryName(name)
    return _trigger(w, trigger).start()


def file_sink(
    df: DataFrame,
    name: str,
    path: str,
    fmt: str = "json",
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
    output_mode: str = "append",
    partition_by: list[str] | None = None,
):
    """Exactly-once file sink (the sink's own log + the checkpoint)."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.option("checkpointLocation", checkpoint_for(df.sparkSession, name, checkpoint)).queryName(name)
    return _trigger(w, trigger).start()


def console_sink(df: DataFrame, name: str, trigger: Mapping[str, object] | None = None, output_mode: str = "append"):
    w = df.writeStream.format("console").outputMode(output_mode).queryName(name)
    return _trigger(w, trigger).start()


def messages(df: DataFrame) -> DataFrame:
    """The queue's ``value``: the record's own text, else its columns as JSON."""
    return df.select("value") if "value" in df.columns else df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def deliver(df: DataFrame, path: str, fmt: str, batch_id: int, bootstrap: str | None = None) -> None:
    """One output of a micro-batch: to the queue (the topic has the name of
    the path's last part; at least once), or to ``<path>/batch=<id>``, where
    a replayed batch replaces its own files and nothing else."""
    if bootstrap:
        topic = path.rstrip("/").rsplit("/", 1)[-1]
        messages(df).write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()
    else:
        df.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")


def fan_out(outputs: Mapping[str, tuple[Column | None, str, str]], bootstrap: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing several outputs of one micro-batch.

    ``outputs`` maps a name to (filter or None, path, format); see
    ``deliver``. The batch is persisted once so the source is read once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for cond, path, fmt in outputs.values():
                part = batch if cond is None else batch.filter(cond)
                deliver(part, path, fmt, batch_id, bootstrap)
        finally:
            batch.unpersist()

    return write


def late_rows_dropped(query) -> int:
    """Rows the stateful operators of ``query`` dropped as late (behind the
    watermark) in its retained progress reports. Spark drops late rows only
    in stateful steps, and may keep a row up to one batch past its
    watermark, so this counts, it does not predict."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total
