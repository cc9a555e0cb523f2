"""Command-line entry points for the jobs (``spark-submit -m``-style).

    python -m verdant.plans.jobs ingest --payloads PATH --checkpoint PATH [--sink-format kafka ...]
    python -m verdant.plans.jobs bronze --bronze PATH --checkpoint PATH [--source-format kafka ...]
    python -m verdant.plans.jobs live   --live PATH --checkpoint PATH ...
    python -m verdant.plans.jobs silver --bronze PATH --silver PATH --start TS --end TS
    python -m verdant.plans.jobs gold   --silver PATH --gold PATH --vpd PATH --serving PATH --start TS --end TS

A scheduler passes the run window (``--start``/``--end``, half-open, ISO times
in UTC or with a zone); reruns replace what the window owns, so retries are
safe.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from verdant.plans.gold import run_gold
from verdant.plans.silver import run_silver
from verdant.session import ensure_session
from verdant.streaming.bronze import WRITERS_PER_PARTITION, start_bronze
from verdant.streaming.ingest import start_ingest
from verdant.streaming.live import start_live


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="verdant.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("bronze", "live"):
        p = sub.add_parser(name)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--source-format", default="kafka")
        p.add_argument("--source-path")
        p.add_argument("--option", action="append", help="source option key=value")
        p.add_argument("--trigger", default="30 seconds" if name == "bronze" else "10 seconds")
        p.add_argument("--bronze" if name == "bronze" else "--live", required=True)
        p.add_argument("--quarantine", help="messages the table can't take (default: next to it)")
        if name == "bronze":
            p.add_argument("--writers-per-partition", type=int, default=WRITERS_PER_PARTITION)
    p = sub.add_parser("ingest")
    p.add_argument("--payloads", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--sink-format", default="kafka")
    p.add_argument("--sink-path")
    p.add_argument("--option", action="append", help="sink option key=value")
    p.add_argument("--trigger", default="10 seconds")
    p = sub.add_parser("silver")
    for a in ("--bronze", "--silver", "--start", "--end"):
        p.add_argument(a, required=True)
    p = sub.add_parser("gold")
    for a in ("--silver", "--gold", "--vpd", "--serving", "--start", "--end"):
        p.add_argument(a, required=True)
    args = ap.parse_args(argv)

    spark = ensure_session(SparkSession.builder.appName(f"verdant-{args.job}").getOrCreate())
    if args.job == "bronze":
        for q in start_bronze(spark, args.bronze, args.checkpoint, fmt=args.source_format,
                              source_path=args.source_path, options=_options(args.option),
                              trigger=args.trigger, quarantine_path=args.quarantine,
                              writers_per_partition=args.writers_per_partition):
            q.awaitTermination()
    elif args.job == "live":
        start_live(spark, args.live, args.checkpoint, fmt=args.source_format, source_path=args.source_path,
                   options=_options(args.option), trigger=args.trigger, quarantine_path=args.quarantine).awaitTermination()
    elif args.job == "ingest":
        start_ingest(spark, args.payloads, args.checkpoint, sink_fmt=args.sink_format, sink_path=args.sink_path,
                     options=_options(args.option), trigger=args.trigger).awaitTermination()
    elif args.job == "silver":
        run_silver(spark, args.bronze, args.silver, args.start, args.end)
    else:
        run_gold(spark, args.silver, args.gold, args.vpd, args.serving, args.start, args.end)
    return 0


if __name__ == "__main__":
    sys.exit(main())
