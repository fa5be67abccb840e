"""Command line for the monthly jobs (``spark-submit`` or ``python -m``).

    python -m sparecast.plans.cli month --as-of 2025-04-15 \
        --billing db.billing --dispatch db.dispatch \
        --master /data/Active_Parts_Master.csv --plan /data/2W_3W_Monthly_Plan.csv \
        --published db.planning_published

    python -m sparecast.plans.cli upload --upload /data/upload.csv --published db.planning_published
    python -m sparecast.plans.cli backtest --as-of 2025-04-15 ...
    python -m sparecast.plans.cli monthly_inputs --as-of 2025-05-15 --run-date 2025-04-03 \
        --order-date 2025-05-01 ...

The session comes from ``SparkSession.builder.getOrCreate()``: cluster
settings (including ``spark.checkpoint.dir``) belong to the submission.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from . import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparecast")
    p.add_argument("step", choices=["month", "classify", "forecast", "apportion", "publish", "upload",
                                    "backtest", "monthly_inputs"])
    p.add_argument("--as-of", help="planning date (YYYY-MM-DD); required except for upload/publish")
    p.add_argument("--segments", default="2W,3W")
    p.add_argument("--billing")
    p.add_argument("--dispatch")
    p.add_argument("--master")
    p.add_argument("--plan")
    p.add_argument("--billing-columns", default="", help="canonical=own,... for columns with other names")
    p.add_argument("--dispatch-columns", default="", help="canonical=own,... for columns with other names")
    p.add_argument("--plan-value", type=float, help="backtest: the plan of the test month (one segment only)")
    p.add_argument("--exclude-text", default="BATTERY")
    p.add_argument("--prefix", default="planning")
    p.add_argument("--published", default="planning_published")
    p.add_argument("--backup", default="planning_published_backup")
    p.add_argument("--mode", choices=["append", "replace_run"], default="append")
    p.add_argument("--upload")
    p.add_argument("--date-pattern", default="yy/MM/dd")
    p.add_argument("--run-date", help="monthly_inputs: run date of the published forecast")
    p.add_argument("--order-date", help="monthly_inputs: order month of the published forecast")
    return p


def _names(text: str) -> dict[str, str] | None:
    return dict(pair.split("=", 1) for pair in text.split(",") if pair) or None


def _monthly_inputs(spark, src, tables, args, segments) -> dict[str, str]:
    """One table per input; the actuals hold all segments, with ``industry``."""
    frames: dict = {}
    for s in segments:
        of_segment = jobs.monthly_inputs(spark, src, tables, args.as_of, args.run_date, args.order_date, s)
        actuals = of_segment.pop("monthly_actuals").withColumn("industry", F.lit(s))
        known = frames.get("monthly_actuals")
        frames["monthly_actuals"] = actuals if known is None else known.unionByName(actuals)
        frames.update(of_segment)   # the others are the same for every segment
    for name, df in frames.items():
        sinks.write_table(df, f"{tables.prefix}_{name}")
    return {name: f"{tables.prefix}_{name}" for name in frames}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"sparecast-{args.step}").getOrCreate()
    src = jobs.Sources(billing=args.billing, dispatch=args.dispatch, master=args.master, plan=args.plan,
                       exclude_text=args.exclude_text, billing_columns=_names(args.billing_columns),
                       dispatch_columns=_names(args.dispatch_columns))
    tables = jobs.Tables(prefix=args.prefix, published=args.published, backup=args.backup or None)
    segments = tuple(s for s in args.segments.split(",") if s)
    out: object = None
    if args.step == "month":
        out = asdict(jobs.run_month(spark, src, tables, args.as_of, segments, args.mode))
    elif args.step in ("classify", "forecast", "apportion"):
        getattr(jobs, args.step)(spark, src, tables, args.as_of, segments)
    elif args.step == "publish":
        out = asdict(jobs.publish(spark, tables, args.mode, segments, args.as_of))
    elif args.step == "upload":
        out = asdict(jobs.upload(spark, tables, args.upload, args.date_pattern))
    elif args.step == "monthly_inputs":
        out = _monthly_inputs(spark, src, tables, args, segments)
    elif args.step == "backtest":
        if args.plan_value is not None and len(segments) != 1:
            raise SystemExit("--plan-value needs exactly one segment")
        rows = ((s, jobs.backtest(spark, src, tables, args.as_of, s, args.plan_value).first()) for s in segments)
        out = {s: row.asDict() for s, row in rows if row is not None}   # one-row reports
    if out is not None:
        print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
