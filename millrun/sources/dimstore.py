"""The store of a dim table: hash buckets of Parquet files and a log.

``<root>/<table>/data/v=<n>/bucket=<b>`` has the rows of the buckets that
version n rewrote; ``<root>/<table>/log/v=<n>`` one row that names, for each
bucket with rows, the version that holds it, and the run and batch that made
the version. A version exists once its log row is committed; data without
one is never read and is overwritten by the next version. Every column is a
string. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_LOG = "version long, run string, batch long, pk string, n_buckets int, columns array<string>, buckets map<int,long>"


def bucket_of(pk: str, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(pk)), F.lit(n_buckets)).cast("int").alias("bucket")


class DimStore:
    def __init__(self, spark: SparkSession, root: str, table: str) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/{table}"

    def _log(self) -> DataFrame | None:
        """The log, or None if there is no table; an unreadable log is an error."""
        try:
            return self.spark.read.schema(_LOG).option("basePath", f"{self.path}/log").parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self, before: int | None = None) -> Row | None:
        log = self._log()
        if log is None:
            return None
        if before is not None:
            log = log.filter(F.col("version") < before)
        return log.orderBy(F.desc("version")).limit(1).first()

    def applied(self, run: str, batch: int) -> bool:
        log = self._log()
        return log is not None and not log.filter((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()

    def read(self, entry: Row, buckets: Sequence[int] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, all or those of some buckets; columns that a
        file lacks are NULL."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or entry["columns"]])
        held = {b: v for b, v in entry["buckets"].items() if buckets is None or b in set(buckets)}
        if not held:
            return self.spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in schema.names])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/v={v}/bucket={b}" for b, v in sorted(held.items())])

    def commit(self, rows: DataFrame | None, touched: Sequence[int], columns: Sequence[str], pk: str, run: str = "", batch: int = -1) -> Row:
        """Write ``rows`` as the touched buckets of the next version; returns its log row."""
        last = self.latest()
        version = 0 if last is None else last["version"] + 1
        n = BUCKETS if last is None else last["n_buckets"]
        held = {} if last is None else {b: v for b, v in last["buckets"].items() if b not in set(touched)}
        if rows is not None and touched:
            data = f"{self.path}/data/v={version}"
            rows.select(*columns, bucket_of(pk, n)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
            schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]).add("bucket", T.IntegerType())
            filled = self.spark.read.schema(schema).parquet(data).select("bucket").distinct()
            held |= {r["bucket"]: version for r in filled.collect()}  # at most n buckets
        values = [F.lit(version), F.lit(run), F.lit(batch), F.lit(pk), F.lit(n), F.array(*[F.lit(c) for c in columns])]
        pointers = F.map_from_arrays(F.array(*[F.lit(b) for b in held]), F.array(*[F.lit(v) for v in held.values()])) if held else F.create_map()
        schema = T.StructType.fromDDL(_LOG)
        row = self.spark.range(1).select(*[v.cast(f.dataType).alias(f.name) for v, f in zip([*values, pointers], schema)])
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/v={version}")
        return self.latest()

    def vacuum(self, keep: int = 10) -> list[int]:
        """Delete the log rows of all but the last ``keep`` versions, then the data that no kept one names."""
        log = self._log()
        if log is None:
            return []
        kept = log.orderBy(F.desc("version")).limit(keep).collect()
        oldest = min((r["version"] for r in kept), default=0)
        named = {(v, b) for r in kept for b, v in r["buckets"].items()}
        jvm = self.spark._jvm.org.apache.hadoop.fs
        folder = jvm.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        gone = []

        def children(path: str):
            at = jvm.Path(path)
            return [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(at)] if fs.exists(at) else []

        for path, name in children(f"{self.path}/log"):
            if name.startswith("v=") and int(name[2:]) < oldest:
                fs.delete(path, True)
        for path, name in children(f"{self.path}/data"):
            version = int(name[2:]) if name.startswith("v=") else oldest
            if version < oldest:  # a version still being written is above
                for bucket, label in children(path.toString()):
                    if label.startswith("bucket=") and (version, int(label[7:])) not in named:
                        fs.delete(bucket, True)
                if not any(v == version for v, _ in named):
                    fs.delete(path, True)
                    gone.append(version)
        return sorted(gone)
