"""Command line: build the tables, or print the alert report.

    python -m shipgauge run --delivery PATH --ml PATH [--root PATH] [--target dev] [--target-schema S]
                            [--on-failure fail|report] [--as-of MOMENT]
    python -m shipgauge report --mart PATH [--out PATH]

``run`` reads the two raw event tables (parquet), writes every table in
dependency order, stops with status 1 if a test, the contract or freshness
fails, and lists the failures. ``report`` prints or writes the latest day's
scores, worst first, and prints the number of teams per tier.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    from shipgauge.session import configure

    return configure(SparkSession.builder.appName("shipgauge").getOrCreate())


def _print_all(df) -> None:
    """Every row, streamed partition by partition."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join(str(x) for x in row))


def cmd_run(args) -> int:
    from shipgauge.plans.pipeline import BuildFailed, Sources, run
    from shipgauge.sources.events import read_delivery_events, read_ml_events

    spark = _session()
    src = Sources(read_delivery_events(spark, args.delivery), read_ml_events(spark, args.ml))
    try:
        out = run(spark, src, target=args.target, target_schema=args.target_schema, root=args.root,
                  on_failure=args.on_failure, as_of=args.as_of)
    except BuildFailed as failed:
        print(f"build failed: {failed}")
        return 1
    failing = out["tests"].where(F.col("failures") > 0).orderBy("test_name")
    print(f"tests failing: {failing.count()}")
    _print_all(failing)
    print(f"contract violations: {out['contract'].count()}")
    _print_all(out["contract"])
    return 0


def cmd_report(args) -> int:
    from shipgauge.plans import reports

    spark = _session()
    mart = spark.read.parquet(args.mart)
    counts = reports.tier_counts(mart).first()
    print(f"critical {counts['critical_teams']}  warning {counts['warning_teams']}  "
          f"healthy {counts['healthy_teams']}  of {counts['teams']} teams")
    report = reports.health_report(mart)
    if args.out:
        report.write.mode("overwrite").option("header", True).csv(args.out)
    else:
        _print_all(report)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="shipgauge")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="build, write and test every table")
    r.add_argument("--delivery", required=True)
    r.add_argument("--ml", required=True)
    r.add_argument("--root", default=None, help="output root (default: <spark.checkpoint.dir>/warehouse)")
    r.add_argument("--target", default="dev")
    r.add_argument("--target-schema", default="analytics_dev")
    r.add_argument("--on-failure", choices=["fail", "report"], default="fail",
                   help="fail: stop with status 1 at the first failing level; report: build all and list failures")
    r.add_argument("--as-of", default=None, help="moment at which the sources' age is measured (default: now)")
    r.set_defaults(fn=cmd_run)
    rep = sub.add_parser("report", help="alert report of the latest day")
    rep.add_argument("--mart", required=True)
    rep.add_argument("--out", default=None, help="folder for the whole report as CSV (default: print it)")
    rep.set_defaults(fn=cmd_report)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
