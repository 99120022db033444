"""Start a job: ``spark-submit run.py <job> …`` (``--help`` lists them)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidelake.functions.match_keys import CENTURY_CUT
from tidelake.operators.arrivals import AWAITED_EXTRACTS
from tidelake.operators.profile import schema_report
from tidelake.plans.arrivals import CORRUPT, drain_and_build, drain_and_open
from tidelake.plans.patient_finder import write_report
from tidelake.plans.rental_mart import ROLES, build_mart
from tidelake.plans.reports import write_pivot, write_rental_profile
from tidelake.sources.tables import read_table
from tidelake.streaming.drain import read_new_files


def mart(spark: SparkSession, args: argparse.Namespace) -> None:
    files = {role: getattr(args, role) for role in ROLES}
    build_mart(spark, files, args.target, mode="append" if args.append else "overwrite")


def finder(spark: SparkSession, args: argparse.Namespace) -> None:
    write_report(spark, args.extract, args.master, args.target, args.cut)


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    table = read_table(spark, args.table)
    schema_report(table).orderBy("position").show(len(table.columns), truncate=False)


def rentals(spark: SparkSession, args: argparse.Namespace) -> None:
    write_rental_profile(spark, {role: getattr(args, role) for role in ROLES}, args.target)


def pivot(spark: SparkSession, args: argparse.Namespace) -> None:
    write_pivot(spark.read.parquet(args.source), args.key, args.column, args.value, args.target)


def wait(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = spark.createDataFrame([], "batch string, source string, ts timestamp_ntz").schema
    arrivals = read_new_files(spark, args.inbox, schema, file_format="json")
    opened, missing = drain_and_open(spark, arrivals, args.state, args.awaited or AWAITED_EXTRACTS)
    opened.write.mode("overwrite").parquet(f"{args.target}/opened")
    missing.write.mode("overwrite").parquet(f"{args.target}/missing")


def arrivals(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = spark.createDataFrame([], f"seq long, body string, {CORRUPT} string").schema
    messages = read_new_files(spark, args.inbox, schema, file_format="json")
    routes = dict(route.split("=", 1) for route in args.route)
    built = drain_and_build(spark, messages, routes, ["seq"], args.state, args.root, args.target)
    print("mart built" if built else "nothing built: no new file for each role")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("mart", help="join rental, payment and customer files into the partitioned mart")
    for role in ROLES:
        job.add_argument(f"--{role}", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--append", action="store_true", help="add to partitions instead of replacing them")
    job.set_defaults(job=mart)

    job = jobs.add_parser("finder", help="match an extract to a master file and report conflicts")
    for name in ("extract", "master", "target"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--cut", type=int, default=CENTURY_CUT, help="first two-digit year of the 1900s")
    job.set_defaults(job=finder)

    job = jobs.add_parser("profile", help="row count and schema of a catalog table")
    job.add_argument("--table", required=True)
    job.set_defaults(job=profile)

    job = jobs.add_parser("rentals", help="profile rental, payment and customer files")
    for name in (*ROLES, "target"):
        job.add_argument(f"--{name}", required=True)
    job.set_defaults(job=rentals)

    job = jobs.add_parser("pivot", help="a Parquet table from long to wide, and as text lines")
    for name in ("source", "key", "column", "value", "target"):
        job.add_argument(f"--{name}", required=True)
    job.set_defaults(job=pivot)

    job = jobs.add_parser("wait", help="drain arrivals (JSON lines of batch, source, ts) and open complete batches")
    for name in ("inbox", "state", "target"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--awaited", action="append", metavar="SOURCE", help="default: the four extracts")
    job.set_defaults(job=wait)

    job = jobs.add_parser("arrivals", help="drain notifications (JSON lines of seq, body) and build the mart")
    for name in ("inbox", "state", "root", "target"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--route", action="append", required=True, metavar="PREFIX=ROLE")
    job.set_defaults(job=arrivals)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(SparkSession.builder.appName("tidelake").getOrCreate(), args)


if __name__ == "__main__":
    main()
