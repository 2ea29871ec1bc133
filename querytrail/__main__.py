"""Command line for the whole jobs.

    python -m querytrail top-searches   --topic search-logs --sink-root out/
    python -m querytrail user-pivot     --topic search-analysis-userid --sink-format mongodb --sink-uri mongodb://h:27017 --sink-database db
    python -m querytrail user-terms     --topic search-analysis-userid --sink-root out/
    python -m querytrail trending       --files topic_dir/ --sink-root out/
    python -m querytrail keyword-stream --topic search-analysis-stream --keyword maske --checkpoint ckpt/ --sink-root out/
    python -m querytrail decode-stream  --topic search-analysis-stream --checkpoint ckpt/
    python -m querytrail live-trending  --topic search-analysis-stream --watermark "10 minutes" --checkpoint ckpt/ --sink-root out/
    python -m querytrail publish        --table events.parquet --topic search-analysis-userid

Sources: a Kafka topic (``--topic``, ``--servers`` or KAFKA_BOOTSTRAP_SERVERS)
or a file topic (``--files``: Parquet with a ``value binary`` column).
Submit with spark-submit to run on a cluster; the master is never set here.
"""

from __future__ import annotations

import argparse
import logging
import sys

from querytrail.operators.pivot import DEFAULT_MAX_VALUES
from querytrail.plans import jobs
from querytrail.session import build_session
from querytrail.sinks.tables import SinkConfig
from querytrail.sources.topics import read_topic, read_topic_files, stream_topic, stream_topic_files
from querytrail.streaming.runner import run_to_end

BATCH = {"top-searches", "user-pivot", "user-terms", "trending"}
STREAM = {"keyword-stream", "decode-stream", "live-trending"}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m querytrail", description=__doc__.split("\n\n")[0])
    p.add_argument("job", choices=sorted(BATCH | STREAM | {"publish"}))
    src = p.add_mutually_exclusive_group()
    src.add_argument("--topic", help="Kafka topic (source, or target for publish)")
    src.add_argument("--files", help="file topic directory (source)")
    p.add_argument("--servers", help="Kafka bootstrap servers")
    p.add_argument("--starting", default=None, help="Kafka startingOffsets (batch default: earliest)")
    p.add_argument("--max-per-trigger", type=int, default=None, help="maxOffsetsPerTrigger / maxFilesPerTrigger")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--sink-root", help="directory for file sinks")
    p.add_argument("--snapshots", action="store_true", help="file sinks: snapshot tables (atomic replace, exactly-once appends)")
    p.add_argument("--sink-uri", help="document store connection URI")
    p.add_argument("--sink-database", help="document store database")
    p.add_argument("--k", type=int, default=10, help="top-k size (top-searches)")
    p.add_argument("--values", help="comma-separated pivot columns (user-pivot); default: from the data")
    p.add_argument("--max-values", type=int, default=DEFAULT_MAX_VALUES, help="user-pivot: most columns; user-terms has no limit")
    p.add_argument("--fill-key", action="store_true", help="user-pivot: null user becomes 0, as the original job did")
    p.add_argument("--width", default="30 minutes", help="window width (trending)")
    p.add_argument("--sort-output", action="store_true", help="trending: write the table sorted by count")
    p.add_argument("--keyword", action="append", help="keyword-stream needle(s); default: maske")
    p.add_argument("--watermark", help="live-trending (required): how late an event may come and still be counted")
    p.add_argument("--mode", default="update", choices=["update", "append", "complete"], help="live-trending output mode")
    p.add_argument("--checkpoint", help="stream checkpoint location (required for streams)")
    p.add_argument("--trigger", default=None, help="processing-time interval, or 'available-now'")
    p.add_argument("--timeout", type=float, default=None, help="stop waiting for a stream after this many seconds")
    p.add_argument("--table", help="publish: Parquet table to send")
    p.add_argument("--preview", action="store_true", help="show results before writing")
    p.add_argument("--drop-malformed", action="store_true", help="batch jobs: drop messages that decode to no field")
    return p


def _trigger(text: str | None, default: dict | None) -> dict | None:
    if text is None:
        return default
    if text in {"available-now", "availableNow"}:
        return {"availableNow": True}
    return {"processingTime": text}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = build_session(f"querytrail-{args.job}")
    sink = SinkConfig(fmt=args.sink_format, root=args.sink_root, uri=args.sink_uri, database=args.sink_database, snapshots=args.snapshots)
    extra = {}

    if args.job == "publish":
        if not (args.table and args.topic):
            raise SystemExit("publish needs --table and --topic")
        jobs.publish_job(spark.read.parquet(args.table), args.topic, args.servers)
        return 0

    if args.job in BATCH:
        if args.files:
            messages = read_topic_files(spark, args.files)
        elif args.topic:
            messages = read_topic(spark, args.topic, args.servers, args.starting or "earliest")
        else:
            raise SystemExit("a source is required: --topic or --files")
        if args.job == "top-searches":
            res = jobs.top_searches_job(messages, sink, k=args.k, preview=args.preview, drop_malformed=args.drop_malformed)
        elif args.job == "user-pivot":
            values = args.values.split(",") if args.values else None
            res = jobs.user_pivot_job(
                messages, sink, values=values, fill_key=args.fill_key, preview=args.preview, drop_malformed=args.drop_malformed,
                max_values=args.max_values,
            )
        elif args.job == "user-terms":
            res = jobs.user_terms_job(messages, sink, preview=args.preview, drop_malformed=args.drop_malformed)
        else:
            res = jobs.trending_job(
                messages, sink, width=args.width, preview=args.preview, sort_output=args.sort_output,
                drop_malformed=args.drop_malformed,
            )
        logging.getLogger("querytrail").info("outputs: %s", res.status)
        return 0

    if args.job == "live-trending" and not args.watermark:
        raise SystemExit("live-trending needs --watermark")
    if not args.checkpoint:
        raise SystemExit("streams need --checkpoint")
    if args.files:
        stream = stream_topic_files(spark, args.files, args.max_per_trigger)
    elif args.topic:
        if args.max_per_trigger:
            extra["maxOffsetsPerTrigger"] = str(args.max_per_trigger)
        stream = stream_topic(spark, args.topic, args.servers, args.starting, **extra)
    else:
        raise SystemExit("a source is required: --topic or --files")
    if args.job == "keyword-stream":
        query = jobs.keyword_tracker_stream(
            stream,
            sink,
            args.checkpoint,
            keywords=tuple(args.keyword or [jobs.KEYWORD]),
            trigger=_trigger(args.trigger, {"processingTime": "10 seconds"}),
        )
    elif args.job == "live-trending":
        query = jobs.live_trending_stream(
            stream, sink, args.checkpoint, watermark=args.watermark, width=args.width, mode=args.mode,
            trigger=_trigger(args.trigger, None),
        )
    else:
        query = jobs.decode_stream(stream, args.checkpoint, trigger=_trigger(args.trigger, None))
    try:
        run_to_end(query, args.timeout)
    except KeyboardInterrupt:  # Ctrl-C: stop the query; the checkpoint resumes it later
        logging.getLogger("querytrail").info("interrupted; stopping %s", query.id)
        query.stop()
        return 130
    return 0


if __name__ == "__main__":
    sys.exit(main())
