"""Command line: ``python -m pubspark run RAW OUT`` builds every layer for the envelope files
under RAW; ``python -m pubspark reports OUT`` prints the three reports of the latest run.

Spark settings (master, memory, ``spark.checkpoint.dir``) come from ``spark-submit`` or the
environment as usual.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pubspark")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="raw envelopes -> raw, bronze, silver, validation layers")
    run.add_argument("raw_path")
    run.add_argument("out_root")
    run.add_argument("--as-of", default=None, help="reference date for future-date checks")
    run.add_argument("--json-lines", action="store_true", help="one envelope per line")
    run.add_argument("--raise-on-fail", action="store_true")
    run.add_argument("--raise-on-broken", action="store_true", help="stop at broken envelopes")
    run.add_argument("--rows", type=int, default=20, help="failed checks shown")
    rep = sub.add_parser("reports", help="print the report queries of one run")
    rep.add_argument("out_root")
    rep.add_argument("--run", default="latest")
    rep.add_argument("--rows", type=int, default=20)
    args = parser.parse_args(argv)

    from pubspark.session import build_session

    spark = build_session()
    if args.command == "run":
        from pubspark.plans.batch import run_pipeline

        res = run_pipeline(spark, args.raw_path, args.out_root, as_of=args.as_of,
                           raise_on_fail=args.raise_on_fail,
                           raise_on_broken=args.raise_on_broken, multi_line=not args.json_lines)
        print(json.dumps({k: res[k] for k in ("build", "commit", "run_count", "kept_back_count", "failed_count")}))
        if res["failed_count"]:
            res["failed_checks"].show(args.rows, truncate=False)
    else:
        from pubspark.analytics_entry import run_reports

        for name, df in run_reports(spark, args.out_root, args.run).items():
            print(f"== {name}")
            df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
