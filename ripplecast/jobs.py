"""Runnable jobs: streaming ingest, batch build of silver + gold, quality report.

    python -m ripplecast.jobs ingest  --root <lake> --files <landing dir> [--available-now]
    python -m ripplecast.jobs ingest  --root <lake> --kafka host:9092 --topic social_media_events
    python -m ripplecast.jobs build   --root <lake>
    python -m ripplecast.jobs update  --root <lake>      (fold new micro-batches into silver and gold)
    python -m ripplecast.jobs report  --root <lake>

`--root` is a folder on shared storage. The ingest job runs two streaming
queries on one source (bronze with dedup, rejects) with separate checkpoints
under `<root>/_checkpoints` and blocks until one of them ends.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ripplecast.operators import quality as Q
from ripplecast.plans.lakehouse import GoldParams, Lakehouse, register_catalog
from ripplecast.session import RECOMMENDED_CONF
from ripplecast.streaming.ingest import file_messages, kafka_messages, start_ingest, start_rejects


def start_streams(
    lake: Lakehouse,
    messages: DataFrame,
    dedup: str = "exact",
    watermark_delay: str = "1 hour",
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Bronze and rejects streams from one message source."""
    bronze = start_ingest(
        messages,
        lake.path("bronze"),
        lake.path("_checkpoints", "bronze"),
        dedup=dedup,
        watermark_delay=watermark_delay,
        trigger=trigger,
        query_name="bronze_ingest",
    )
    rejects = start_rejects(messages, lake.path("rejects"), lake.path("_checkpoints", "rejects"), trigger=trigger)
    return [bronze, rejects]


def build_batch(lake: Lakehouse) -> None:
    """SILVER then GOLD, each layer overwritten as a whole."""
    lake.build_silver()
    lake.build_gold()
    register_catalog(lake)


def update_batch(lake: Lakehouse) -> bool:
    """Fold the bronze micro-batches committed since the last build into
    SILVER, then GOLD; both rewrite only the dates the new events touch."""
    changed = lake.update_silver()
    if changed or lake.gold_pending():  # also dates of an update whose gold failed
        lake.update_gold()
    register_catalog(lake)
    return changed


def _session(app: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ripplecast.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--root", required=True)
    src = ing.add_mutually_exclusive_group(required=True)
    src.add_argument("--files")
    src.add_argument("--kafka")
    ing.add_argument("--topic", default="social_media_events")
    ing.add_argument("--starting-offsets", default="latest")
    ing.add_argument("--dedup", choices=["exact", "watermark"], default="exact")
    ing.add_argument("--watermark-delay", default="1 hour")
    ing.add_argument("--available-now", action="store_true")
    ing.add_argument("--max-files-per-trigger", type=int, default=None, help="rate limit of the file source")
    ing.add_argument("--max-offsets-per-trigger", type=int, default=None, help="rate limit of the Kafka source")
    for name in ("build", "update"):
        bld = sub.add_parser(name)
        bld.add_argument("--root", required=True)
        bld.add_argument("--windows", default="1,5,15")
        bld.add_argument("--viral-minutes", type=int, default=5)
        bld.add_argument("--viral-threshold", type=int, default=500)
    rep = sub.add_parser("report")
    rep.add_argument("--root", required=True)
    args = ap.parse_args(argv)

    spark = _session(f"ripplecast-{args.cmd}")
    if args.cmd == "ingest":
        lake = Lakehouse(spark, args.root)
        if args.files:
            messages = file_messages(spark, args.files, args.max_files_per_trigger)
        else:
            extra = {"maxOffsetsPerTrigger": str(args.max_offsets_per_trigger)} if args.max_offsets_per_trigger else {}
            messages = kafka_messages(spark, args.kafka, args.topic, startingOffsets=args.starting_offsets, **extra)
        trigger = {"availableNow": True} if args.available_now else None
        queries = start_streams(lake, messages, args.dedup, args.watermark_delay, trigger)
        if args.available_now:
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        return 0
    if args.cmd in ("build", "update"):
        params = GoldParams(
            trending_windows_minutes=tuple(int(x) for x in args.windows.split(",")),
            viral_window_minutes=args.viral_minutes,
            viral_threshold=args.viral_threshold,
        )
        lake = Lakehouse(spark, args.root, params)
        build_batch(lake) if args.cmd == "build" else update_batch(lake)
        return 0
    if args.cmd == "report":
        lake = Lakehouse(spark, args.root)
        report = Q.quality_report(lake.curated(), lake.users(), lake.posts())
        report.write.mode("overwrite").parquet(lake.path("gold", "quality_report"))
        lake.gold("quality_report").show(truncate=False)  # nine rows
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
