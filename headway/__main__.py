"""Command line: ``python -m headway <batch|speed|microbatch|archive|merge|query> ...`` (use with spark-submit)."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime


def _ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="headway")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("batch", help="route statistics, top routes and batch view from the archive")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--since")
    b.add_argument("--until")
    b.add_argument("--incremental", action="store_true",
                   help="read only hour folders that no incremental run has read, up to the last full hour")
    b.add_argument("--ranges", help="keep event-time ranges of hour folders here, and prune --since/--until by them")

    s = sub.add_parser("speed", help="speed layer over a directory of JSON-line files")
    s.add_argument("--input", required=True)
    s.add_argument("--batch-view", required=True, help="Parquet batch view written by 'batch'")
    s.add_argument("--view", required=True)
    s.add_argument("--snapshots", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--size", default="5 minutes")
    s.add_argument("--slide", default="30 seconds")
    s.add_argument("--watermark", default="10 minutes")
    s.add_argument("--every", type=int, default=30, help="trigger interval, seconds")
    s.add_argument("--correct-late", action="store_true", help="add late events to their windows, too")
    s.add_argument("--expire", action="store_true", help="drop rows past their TTL when tables are compacted")
    s.add_argument("--compact-every", type=int, default=50, help="micro-batches between compactions")
    s.add_argument("--archive", help="also archive the same read of the input here")
    s.add_argument("--bad", help="with --archive: keep lines that are no records here")
    s.add_argument("--envelopes", action="store_true",
                   help="input lines are delivered batches (Records[].kinesis.data, base64)")

    mb = sub.add_parser("microbatch", help="per-delivery route statistics and counters")
    mb.add_argument("--input", required=True, help="directory of envelope JSON lines")
    mb.add_argument("--batch-view", required=True)
    mb.add_argument("--stats", required=True)
    mb.add_argument("--counters", required=True)
    mb.add_argument("--checkpoint", required=True)
    mb.add_argument("--every", type=int, default=60)

    a = sub.add_parser("archive", help="archive JSON-line files by flush hour")
    a.add_argument("--input", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--every", type=int, default=60)
    for stream in (s, mb, a):
        stream.add_argument("--format", default="text", help="text (a folder of files), kafka (a topic), or any other")
        stream.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the source")
        stream.add_argument("--start", default="earliest", help="latest, earliest, or an ISO time")
        stream.add_argument("--skip-missed", action="store_true",
                            help="a folder: resolve --start anew at a restart instead of going on")
        stream.add_argument("--max-files", type=int, default=100, help="files of one read of a folder")
        stream.add_argument("--max-records", type=int, help="records of one read of a topic "
                            "(default 500, archive 100)")
        stream.add_argument("--once", action="store_true", help="process what is there, then stop")

    m = sub.add_parser("merge", help="verdict per route from the published batch and speed views")
    m.add_argument("--batch-view", required=True)
    m.add_argument("--view", required=True)
    m.add_argument("--as-of", help="ISO time, default now (UTC)")
    m.add_argument("--route")
    m.add_argument("--ttl", action="store_true", help="ignore speed rows older than their TTL")
    m.add_argument("--output", help="write Parquet here instead of printing")

    q = sub.add_parser("query", help="run one registered query on a data folder")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--rows", type=int, default=20)

    args = p.parse_args(argv)
    from headway.session import build_session

    spark = build_session(f"headway-{args.cmd}")

    if args.cmd == "batch":
        from headway.plans.batch_job import run_batch_job, run_incremental_job
        from headway.sources import hours

        if args.incremental:
            paths = run_incremental_job(spark, args.input, args.output)
            print("no new hour folders" if paths is None else paths)
            return 0
        raw = None
        if args.ranges:
            hours.update_ranges(spark, args.input, args.ranges)
            raw = hours.read_between(spark, args.input, args.ranges, _ts(args.since), _ts(args.until))
        paths = run_batch_job(spark, args.input, args.output, _ts(args.since), _ts(args.until), raw)
        print("no input records" if paths is None else paths)
        return 0 if paths is not None else 1

    if args.cmd == "merge":
        from datetime import timezone

        from headway.plans.serving_job import route_verdicts

        as_of = _ts(args.as_of) or datetime.now(timezone.utc).replace(tzinfo=None)
        out = route_verdicts(spark, args.view, args.batch_view, as_of, args.route, args.ttl)
        if args.output:
            out.write.mode("overwrite").parquet(args.output)
        else:
            total = out.count()
            out.show(50, truncate=False)
            print(f"{min(total, 50)} of {total} routes shown; --output writes all")
        return 0

    if args.cmd == "query":
        from headway.plans.catalog import QUERIES

        QUERIES[args.name](spark, args.data).show(args.rows, truncate=False)
        return 0

    from headway.sources import raw as RW
    from headway.sources.published import read_view
    from headway.streaming import jobs as J
    from headway.streaming import positions as P

    records = args.max_records or (P.ARCHIVE_READ if args.cmd == "archive" else P.SPEED_READ)
    per_read = args.max_files if args.format == "text" else records
    lines = P.lines_from(spark, args.input, args.format, args.start, args.checkpoint, not args.skip_missed, per_read,
                         dict(o.split("=", 1) for o in args.option))

    def trigger(seconds: int):
        return J.REPLAY if args.once else J.production_trigger(seconds)

    def baseline(sp):
        return read_view(sp, args.batch_view)           # the version of now, once for each batch

    if args.cmd == "archive":
        query = J.start_archive(lines, args.output, args.checkpoint, trigger(args.every))
    elif args.cmd == "microbatch":
        query = J.start_microbatch(RW.decode_envelope(lines), args.stats, args.counters, args.checkpoint,
                                   baseline, trigger=trigger(args.every))
    elif args.archive:
        query = J.start_fan_out_once(lines, args.archive, args.view, args.snapshots, args.checkpoint, baseline,
                                     trigger(args.every), None, args.size, args.slide, args.watermark, args.bad,
                                     compact_every=args.compact_every, expire=args.expire)
    else:
        if args.envelopes:
            lines = RW.decode_envelope(lines)
        query = J.start_speed_layer(RW.parse_speed_records(lines), args.view, args.snapshots, args.checkpoint,
                                    baseline, args.size, args.slide, args.watermark, trigger(args.every),
                                    correct_late=args.correct_late, compact_every=args.compact_every, expire=args.expire)
    query.awaitTermination()            # runs until stopped, or until done with --once
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
