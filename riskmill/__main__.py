"""Command line: ``python -m riskmill <job> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from riskmill import jobs
from riskmill.session import build_session
from riskmill.sources.paths import Layout, resolve
from riskmill.sources.run_log import RunLog


def _parser() -> argparse.ArgumentParser:
    layout = Layout()
    parser = argparse.ArgumentParser(prog="riskmill", description="Transaction-risk pipeline on Spark")
    parser.add_argument("--master", help="Spark master; by default the one of spark-submit")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="Spark setting")
    parser.add_argument("--run-log", metavar="FOLDER", help="log the run; refuse it if the job before has failed")
    sub = parser.add_subparsers(dest="job", required=True)

    bronze = sub.add_parser("bronze", help="raw files to day partitions")
    bronze.add_argument("source", help="CSV file or folder; a bare path is a local one")
    bronze.add_argument("target", nargs="?", default=layout.bronze)
    bronze.add_argument("--format", choices=["csv", "parquet"], default="csv")
    bronze.add_argument("--only-new-days", action="store_true", help="keep the days the source does not have")

    silver = sub.add_parser("silver", help="clean Bronze and derive features")
    silver.add_argument("source", nargs="?", default=layout.bronze)
    silver.add_argument("target", nargs="?", default=layout.silver)
    silver.add_argument("--days", help="Bronze days that are new or changed, as yyyy-MM-dd,...; by default all")

    gold = sub.add_parser("gold", help="publish the star schema")
    gold.add_argument("source", nargs="?", default=layout.silver)
    gold.add_argument("target", nargs="?", default=layout.gold)
    gold.add_argument("--database", default="gold")
    gold.add_argument("--format", default="parquet", help="table format known to the session")
    gold.add_argument("--fact-buckets", type=int)
    gold.add_argument("--by-days", metavar="DAYS", help="keep what each day contributes; Silver days that are new, changed or gone, as yyyy-MM-dd,..., or all")

    train = sub.add_parser("train", help="train and register the model")
    train.add_argument("source", nargs="?", default=layout.silver)
    train.add_argument("models", nargs="?", default=layout.models)
    train.add_argument("--without-label-flags", action="store_true")

    score = sub.add_parser("score", help="score Silver with the latest model")
    score.add_argument("target")
    score.add_argument("--source", default=layout.silver)
    score.add_argument("--models", default=layout.models)

    stream = sub.add_parser("stream-score", help="score new transaction files with the latest model")
    stream.add_argument("target")
    stream.add_argument("checkpoint")
    stream.add_argument("--source", default=layout.bronze)
    stream.add_argument("--models", default=layout.models)

    merge = sub.add_parser("merge-stream", help="merge the newest copies of new transaction files into buckets of ids")
    merge.add_argument("target")
    merge.add_argument("checkpoint")
    merge.add_argument("--source", default=layout.bronze)
    merge.add_argument("--buckets", type=int, default=jobs.SURVIVOR_BUCKETS, help="fixed for the life of the target")

    payload = sub.add_parser("payload-score", help="decide on JSON payloads with the latest model")
    payload.add_argument("source")
    payload.add_argument("target")
    payload.add_argument("rejects")
    payload.add_argument("--models", default=layout.models)
    payload.add_argument("--checkpoint", help="take only files not seen before, as a stream")
    return parser


# Whose last run must have succeeded before a job starts, when a log is given.
AFTER = {"silver": ["bronze"], "gold": ["silver"], "train": ["silver"], "score": ["train"], "stream-score": ["train"], "payload-score": ["train"]}


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"riskmill-{args.job}", args.master, dict(c.split("=", 1) for c in args.conf))
    if args.run_log:
        with RunLog(spark, args.run_log).run(args.job, AFTER.get(args.job, [])):
            done = _run(spark, args)
    else:
        done = _run(spark, args)
    print(json.dumps(done))


def _run(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.job == "bronze":
        return jobs.run_bronze(spark, resolve(args.source), args.target, args.format, not args.only_new_days)
    if args.job == "silver":
        return jobs.run_silver(spark, args.source, args.target, args.days.split(",") if args.days else None)
    if args.job == "gold" and args.by_days:
        days = None if args.by_days == "all" else args.by_days.split(",")
        return jobs.run_gold_days(spark, args.source, args.target, args.database, days, args.format)
    if args.job == "gold":
        return jobs.run_gold(spark, args.source, args.target, args.database, args.format, args.fact_buckets)
    if args.job == "train":
        return jobs.run_training(spark, args.source, args.models, args.without_label_flags)
    if args.job == "score":
        return {"rows": jobs.run_scoring(spark, args.source, args.models, args.target)}
    if args.job == "stream-score":
        return {"rows": jobs.run_stream_scoring(spark, args.source, args.models, args.target, args.checkpoint)}
    if args.job == "merge-stream":
        return {"rows": jobs.run_survivor_stream(spark, args.source, args.target, args.checkpoint, args.buckets)}
    paths = (args.source, args.models, args.target, args.rejects)
    if args.checkpoint:
        return jobs.run_payload_stream(spark, *paths, args.checkpoint)
    return jobs.run_payload_scoring(spark, *paths)


if __name__ == "__main__":
    main()
