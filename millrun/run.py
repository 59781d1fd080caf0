"""Command-line launcher for the streaming jobs.

    python -m millrun.run e1 --bootstrap broker:9092 --out /warehouse
    python -m millrun.run e3 --source files --input /landing/manufacture --out /warehouse --once

Each job reads its topics from the message queue (``--source kafka``,
the default) or from folders of JSON lines (``--source files``, one
folder per topic under ``--input``), writes under ``--out``, and keeps its
checkpoint under the session's ``spark.checkpoint.dir``. ``--once``
processes what is available and stops.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrun.operators import parse
from millrun.session import build_session
from millrun.sources.shapes import INSPECTION_EVENT, PRODUCTION_DIM, RULE
from millrun.sources.tables import load_side
from millrun.streaming import io, jobs

# Inspection header/detail records: order id, event time (epoch ms) and
# the equipment that did the work (used by the equipment lookup).
INSPECT_RECORD = "orderId string, ts long, equipmentId string"

# Topic names of the source design.
TOPICS = {
    "e1": ["ods_log_topic"],
    "e2": ["ods_db"],
    "e3": ["dwd_manufacture_log"],
    "e4": ["dwd_inspect_info", "dwd_inspect_detail"],
    "e5": ["dwd_inspect_detail_topic", "dwm_inspect_per_dimension_topic", "dwm_inspect_double_topic"],
}


def _text(spark: SparkSession, args, topic: str) -> DataFrame:
    if args.source == "kafka":
        return io.kafka_text_source(spark, topic, args.bootstrap, max_offsets_per_trigger=args.max_offsets)
    return io.file_text_source(spark, f"{args.input}/{topic}", args.max_files)


def _trigger(args, job: str):
    return {"availableNow": True} if args.once else {"processingTime": jobs.TRIGGERS[job]}


def start(args, spark: SparkSession) -> list:
    """Start a job's queries; with the queue as source, outputs go to its topics."""
    job, out = args.job, args.out.rstrip("/")
    topics = args.topics or TOPICS[job]
    trigger = _trigger(args, job)
    queue = args.bootstrap if args.source == "kafka" else None
    if job == "e1":
        return [jobs.start_e1(_text(spark, args, topics[0]), out, trigger=trigger, bootstrap=queue)]
    if job == "e2":
        return [jobs.start_e2(
            _text(spark, args, topics[0]), lambda: load_side(spark, args.rules, RULE),
            out, f"{out}/dim", trigger=trigger, bootstrap=queue,
        )]
    if job == "e3":
        return [jobs.start_e3(_text(spark, args, topics[0]), out, trigger=trigger, cleanup=not args.once, bootstrap=queue)]
    if job == "e4":
        schema = T.StructType.fromDDL(INSPECT_RECORD)
        parsed = [parse.parse_records(_text(spark, args, t), schema, "orderId") for t in topics[:2]]
        info, detail = (parse.good(p).drop("raw") for p in parsed)
        wide = jobs.e4_stream(info, detail)
        if args.equipment:  # equipment dim re-read for every micro-batch
            main_query = jobs.start_e4_fresh_dims(wide, lambda: load_side(spark, args.equipment),
                                                  f"{out}/dwm_inspect_wide", trigger=trigger, bootstrap=queue)
        else:
            main_query = jobs.start_e4(wide, f"{out}/dwm_inspect_wide", trigger=trigger, bootstrap=queue)
        return [main_query, jobs.start_dead_letters(parsed, out, "e4_dead_letter", trigger, bootstrap=queue)]
    if job == "e5":
        parsed = [parse.parse_records(_text(spark, args, t), INSPECTION_EVENT, "mid") for t in topics[:3]]
        feeds = [parse.good(p).select("mid", "isNew", "isPass", "ts") for p in parsed]
        grain = jobs.e5_grain_stream(*feeds, window=args.window, per_feed=args.watermark == "feed")
        # the production dim is re-read for every micro-batch (fresh lookups)
        main_query = jobs.start_e5_fresh_dims(
            grain, lambda: load_side(spark, args.production, PRODUCTION_DIM), f"{out}/dws_size_stats",
            args.window, trigger=trigger, bootstrap=queue,
        )
        return [main_query, jobs.start_dead_letters(parsed, out, "e5_dead_letter", trigger, bootstrap=queue)]
    raise ValueError(job)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrun.run", description=__doc__.split("\n\n")[0])
    p.add_argument("job", choices=sorted(TOPICS))
    p.add_argument("--out", required=True)
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap", default="localhost:9092")
    p.add_argument("--input", help="root folder of per-topic JSON-lines folders (--source files)")
    p.add_argument("--topics", nargs="*", help="override the job's topic names, in order")
    p.add_argument("--rules", help="E2: rule table (table_process): a Parquet path, or jdbc:<url>#<table>")
    p.add_argument("--equipment", help="E4: equipment dim (id, start_date): Parquet path or jdbc:<url>#<table>")
    p.add_argument("--production", help="E5: production dim (id, eId, Fid, mType, lid): Parquet path or jdbc:<url>#<table>")
    p.add_argument("--window", default="10 seconds", help="E5: tumbling window length")
    p.add_argument("--watermark", choices=["union", "feed"], default="union",
                   help="E5: one watermark for all feeds, or the least of one per feed (none may fall silent)")
    p.add_argument("--max-offsets", type=int, default=5_000_000)
    p.add_argument("--max-files", type=int, default=io.MAX_FILES)
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--master", default=None, help="only without a submit; a submit decides master, memory and partitions")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session(master=args.master, app_name=f"millrun-{args.job}")
    for q in start(args, spark):
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
