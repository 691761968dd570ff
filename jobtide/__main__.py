"""Command line: ``python -m jobtide {land,build,check,run} …`` on the session spark-submit provides."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobtide import fixed
from jobtide.plans import suites
from jobtide.plans.build import Build, RunError, full_run, land
from jobtide.schemas import RESPONSES
from jobtide.session import pin


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="jobtide")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, what in (
        ("land", "pack landed responses into the raw table"),
        ("build", "build models from the raw table"),
        ("check", "run the quality checks and fail unless all pass"),
        ("run", "land, build and check"),
    ):
        command = commands.add_parser(name, help=what)
        command.add_argument("--raw", required=True, help="folder of the raw table")
        command.add_argument("--work", help="folder shared by all executors; by default that of spark.checkpoint.dir")
        if name in ("land", "run"):
            command.add_argument("--responses", required=True, help="folder of landed responses")
            command.add_argument("--source", action="append", choices=fixed.SOURCES, help="only these sources")
        if name != "land":
            command.add_argument("--marts", required=True, help="folder of the marts")
        if name == "build":
            command.add_argument("--select", action="append", help="only these layers or models")
        if name == "check":
            command.add_argument("--models", action="store_true", help="check what the models declare instead")
    return parser.parse_args(argv)


def _show(runs: DataFrame) -> None:
    """A line for every run: counts, or all that went wrong."""
    for run in runs.orderBy("source", "ingested_at", "run_id").toLocalIterator():
        counts = f"{run['n_ok']} of {run['n_requests']} requests, {run['job_count']} postings in {run['payloads']} payload(s)"
        print("\t".join([run["source"], run["run_id"], run["status"], run["error"] or counts]))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one command; the exit code is 0 only if it went well."""
    arguments = _arguments(argv)
    spark = pin(spark or SparkSession.builder.appName("jobtide").getOrCreate())
    try:
        if arguments.command in ("land", "run"):
            landed = spark.read.schema(RESPONSES).parquet(arguments.responses)
        if arguments.command == "land":
            _show(land(landed, arguments.raw, arguments.source, work=arguments.work))
        elif arguments.command == "run":
            _show(full_run(landed, arguments.raw, arguments.marts, arguments.source, work=arguments.work))
        else:
            build = Build(spark, arguments.raw, arguments.marts, work=arguments.work)
            if arguments.command == "build":
                print("\n".join(build.run(arguments.select)))
            else:
                results = build.check_models() if arguments.models else build.check()
                print(suites.format_report(results))
                suites.gate(results)
    except (RunError, suites.QualityError) as error:
        print(f"Error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
