"""Command line: run every pipeline file of a folder (or one file) and print the
outcome of each source and the latest runs.

    python -m tributary run pipelines/ [--output-root DIR] [--format parquet]
                                       [--include-scheduled] [--history 10] [--master URL]
                                       [--parallel-sources N]

Under ``spark-submit`` the submitted configuration is used; otherwise a local
session is started.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tributary.plans.runner import Runner
from tributary.plans.specs import PipelineSpec, load_pipelines


def _session(master: str | None) -> SparkSession:
    """The active session; else one on ``--master``; else the master spark-submit
    configured; else a local session."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if master:
        return SparkSession.builder.master(master).getOrCreate()
    from pyspark import SparkConf

    if SparkConf().contains("spark.master"):
        return SparkSession.builder.getOrCreate()
    from tributary.session import local_session

    return local_session()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tributary")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run pipelines")
    run.add_argument("path", help="a pipeline JSON file or a folder of them")
    run.add_argument("--output-root", default=None)
    run.add_argument("--format", default="parquet")
    run.add_argument("--include-scheduled", action="store_true")
    run.add_argument("--history", type=int, default=10)
    run.add_argument("--master", default=None)
    run.add_argument("--parallel-sources", type=int, default=1)
    args = parser.parse_args(argv)

    pipelines = ([PipelineSpec.from_json(args.path)] if os.path.isfile(args.path)
                 else load_pipelines(args.path))
    if not pipelines:
        print(f"no pipelines found in {args.path}")
        return 0
    spark = _session(args.master)
    runner = Runner(spark, args.output_root, table_format=args.format,
                    parallel_sources=args.parallel_sources)
    failures = 0
    for pipeline in pipelines:
        for r in runner.run_pipeline(pipeline, include_scheduled=args.include_scheduled):
            failures += r.status != "SUCCESS"
            print(f"{pipeline.name}/{r.source}: {r.status} table={r.table} action={r.table_action} "
                  f"read={r.rows_read} written={r.rows_written}" + (f" error={r.error}" if r.error else ""))
    if spark.catalog.tableExists(runner.audit_table):
        for row in runner.run_history(args.history).collect():
            print(f"  {row.started_at} {row.job_name} {row.status} {row.run_id}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
