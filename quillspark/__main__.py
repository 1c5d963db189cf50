"""python -m quillspark build|submit|collect: asynchronous batch jobs from files of a folder.

build writes request lines, submit starts a job from them and keeps its state, collect fetches its
results once it is completed; its exit code is 3 until then. MODEL_API_BASE and MODEL_API_KEY name
the service, and are needed by submit and collect alone.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .plans.preflight import preflight
from .plans.runs import batch_requests, batch_results, batch_routes
from .sources import files
from .sources.model_api import BatchJobs

NOT_YET = 3


def build(spark: SparkSession, folder: str, stage: str, to: str, routes: str | None) -> None:
    """Request lines of the live files of folder, duplicates included; extraction takes the results of the routing batch."""
    found = files.scan(spark, folder, suffixes=files.BATCH_SUFFIXES)
    live = found.join(preflight(found, dedupe=False).filter("ok").select("path"), "path")
    known = batch_routes(batch_results(spark.read.text(routes), "route")) if routes else None
    batch_requests(live, stage, known).write.mode("overwrite").text(to)


def main(argv: list[str] | None = None, jobs: BatchJobs | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillspark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    b = commands.add_parser("build")
    b.add_argument("folder")
    b.add_argument("stage", choices=["route", "extract", "baseline"])
    b.add_argument("to")
    b.add_argument("--routes")
    for name, second in (("submit", "state"), ("collect", "to")):
        c = commands.add_parser(name)
        c.add_argument("lines" if name == "submit" else "state")
        c.add_argument(second)
    args = parser.parse_args(argv)
    if args.command == "build":
        build(spark or SparkSession.builder.getOrCreate(), args.folder, args.stage, args.to, args.routes)
        return 0
    jobs = jobs or BatchJobs(os.environ["MODEL_API_BASE"], os.environ["MODEL_API_KEY"])
    if args.command == "submit":
        with open(args.lines, "rb") as f:
            print(jobs.submit(f.read(), args.state)["id"])
        return 0
    status = jobs.collect(args.state, args.to)
    print(status)
    return 0 if status == "completed" else NOT_YET


if __name__ == "__main__":
    sys.exit(main())
