"""spark-submit entry points, one per zone job.

    spark-submit --py-files tablezones.zip tablezones/cli.py land <input> <raw_path> [--format json|parquet]
    spark-submit --py-files tablezones.zip tablezones/cli.py structure <raw_path> <foundation_path> [--schema DDL]
    spark-submit --py-files tablezones.zip tablezones/cli.py transform <foundation_path> <trusted_path>
    spark-submit --py-files tablezones.zip tablezones/cli.py save <trusted_path> <table> --host H --database D [--user U] [--password-file F]
    spark-submit --py-files tablezones.zip tablezones/cli.py all <raw> <foundation> <trusted> [--schema DDL] [--url URL --table T]
    spark-submit --py-files tablezones.zip tablezones/cli.py profile <parquet_path> [--rows N]

The master, memory and executors come from spark-submit, never from here.
Any failure raises, so the process exits non-zero and a scheduler stops the
chain instead of running the next job on stale data. Malformed input is a
failure too, unless ``--on-corrupt quarantine`` says to go on without it.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from tablezones.operators import preview, profile_columns
from tablezones.plans.countries import FEED_SCHEMA
from tablezones.plans.pipelines import ON_CORRUPT, Zones, run_end_to_end, save, structure, transform
from tablezones.sinks import WriteReport, land_json_documents, mysql_url
from tablezones.sources import read_json_lines, read_parquet

NAMED_SCHEMAS = {"countries": FEED_SCHEMA}
#: Settings that stand in for arguments which are not given.
SETTINGS = {"host": "TABLEZONES_DB_HOST", "port": "TABLEZONES_DB_PORT", "database": "TABLEZONES_DB_NAME", "user": "TABLEZONES_DB_USER"}
PASSWORD_SETTING = "TABLEZONES_DB_PASSWORD"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablezones")
    sub = p.add_subparsers(dest="job", required=True)
    n = sub.add_parser("land", help="records (JSON lines or Parquet) -> raw JSON documents")
    n.add_argument("input_path")
    n.add_argument("output_path")
    n.add_argument("--format", default="json", choices=["json", "parquet"])
    n.add_argument("--compression")
    s = sub.add_parser("structure", help="raw JSON documents -> foundation Parquet")
    s.add_argument("input_path")
    s.add_argument("output_path")
    _structure_args(s)
    t = sub.add_parser("transform", help="foundation Parquet -> flat trusted Parquet")
    t.add_argument("input_path")
    t.add_argument("output_path")
    v = sub.add_parser("save", help="trusted Parquet -> JDBC table")
    v.add_argument("input_path")
    v.add_argument("table")
    _jdbc_args(v)
    a = sub.add_parser("all", help="raw -> foundation -> trusted (-> table), stopping at the first failure")
    a.add_argument("raw_path")
    a.add_argument("foundation_path")
    a.add_argument("trusted_path")
    a.add_argument("--table", help="also run the save stage, into this table")
    _structure_args(a)
    _jdbc_args(a)
    f = sub.add_parser("profile", help="schema, counts of rows and NULLs, and first rows of a Parquet zone")
    f.add_argument("input_path")
    f.add_argument("--rows", type=int, default=5)
    return p


def _structure_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--schema", help="DDL types or 'countries' for the fields they name; all others are inferred")
    p.add_argument("--on-corrupt", default="fail", choices=ON_CORRUPT)
    p.add_argument("--num-files", type=int, help="rebalance parsed rows into this many files")


def _jdbc_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--url", help="JDBC URL; or give --host and --database for MySQL")
    p.add_argument("--host")
    p.add_argument("--port", type=int)
    p.add_argument("--database")
    p.add_argument("--user")
    p.add_argument("--password-file", help="file holding the password (kept off the command line)")
    p.add_argument("--num-partitions", type=int)
    p.add_argument("--truncate", action="store_true")


def _setting(args, name: str):
    given = getattr(args, name)
    return given if given is not None else os.environ.get(SETTINGS[name])


def _url(args) -> str | None:
    """The JDBC URL that the arguments name; settings complete them but do not ask for a save on their own."""
    if args.url:
        return args.url
    host, database = _setting(args, "host"), _setting(args, "database")
    return mysql_url(host, database, int(_setting(args, "port") or 3306)) if host and database else None


def _jdbc_options(args) -> dict:
    password = os.environ.get(PASSWORD_SETTING)
    if args.password_file:
        with open(args.password_file, encoding="utf-8") as fh:
            password = fh.read().strip()
    return {"user": _setting(args, "user"), "password": password, "num_partitions": args.num_partitions, "truncate": args.truncate}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "schema", None):
        args.schema = NAMED_SCHEMAS.get(args.schema, args.schema)
    if args.job == "save" and not _url(args):
        parser.error("save needs --url, or --host and --database")
    if args.job == "all":
        if args.table and not _url(args):
            parser.error("--table needs --url, or --host and --database")
        if not args.table and (args.url or args.host or args.database):
            parser.error("a database without --table saves nothing: add --table")
    return args


def _say(job: str, report: WriteReport) -> None:
    print(json.dumps({"job": job, "target": report.target, "written": report.written, **report.metrics}))


def _profile(spark: SparkSession, path: str, rows: int) -> None:
    df = read_parquet(spark, path)
    for row in profile_columns(df, with_types=True).collect():  # one row a column
        print(json.dumps(row.asDict()))
    for text in preview(df, [df.columns[0]], rows).toJSON().collect():
        print(text)


def main(argv: list[str] | None = None) -> int:
    """Run one job (or all of them) and print one JSON line of metrics per stage."""
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"tablezones-{args.job}").getOrCreate()
    try:
        if args.job == "land":
            read = read_json_lines if args.format == "json" else read_parquet
            options = {"on_corrupt": "fail"} if args.format == "json" else {}
            _say("land", land_json_documents(read(spark, args.input_path, **options), args.output_path, compression=args.compression, inputs=[args.input_path]))
        elif args.job == "structure":
            _say("structure", structure(spark, args.input_path, args.output_path, args.schema, args.on_corrupt, args.num_files))
        elif args.job == "transform":
            _say("transform", transform(spark, args.input_path, args.output_path))
        elif args.job == "save":
            _say("save", save(spark, args.input_path, _url(args), args.table, **_jdbc_options(args)))
        elif args.job == "profile":
            _profile(spark, args.input_path, args.rows)
        else:
            zones = Zones(args.raw_path, args.foundation_path, args.trusted_path)
            jdbc = {"url": _url(args), "table": args.table, **_jdbc_options(args)} if args.table else None
            for stage, report in run_end_to_end(spark, zones, args.schema, jdbc=jdbc, on_corrupt=args.on_corrupt, num_files=args.num_files).items():
                _say(stage, report)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
