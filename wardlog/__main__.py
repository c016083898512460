"""Starts one of the jobs, with spark-submit or `python -m wardlog`."""

import argparse
from datetime import timedelta

from pyspark.sql import SparkSession

from wardlog import schema as S
from wardlog.plans import jobs


def parser():
    out = argparse.ArgumentParser(prog="wardlog")
    job = out.add_subparsers(dest="job", required=True)

    def add(name, text):
        one = job.add_parser(name, help=text)
        one.add_argument("--data", required=True, help="folder of the stored tables")
        return one

    one = add("preprocess", "logs to stored events, sessions and commands")
    one.add_argument("--logs", nargs="+", required=True, help="log folders")
    one.add_argument("--per-file", action="store_true", help="keep of a session only its part in the greatest file")
    one.add_argument("--pattern", default=S.LOG_FILE_PATTERN, help="names of the log files")
    add("explore", "profiles and summary")
    add("train", "models, clusters and response map")
    one = add("evaluate", "hold-out and cross-validated metrics")
    one.add_argument("--noise", type=float, default=0.05, help="standard deviation of the added noise")
    one.add_argument("--folds", type=int, default=5)
    one.add_argument("--scale-scope", choices=["train", "fold"], default="train", help="rows that scaling is fitted on")
    add("report", "tables of the trained models")
    one = add("watch", "decide live")
    one.add_argument("--logs", required=True, help="the folder to watch")
    one.add_argument("--pattern", help=f"names of the log files ({S.FINISHED_LOG_PATTERN}, with --follow {S.LOG_FILE_PATTERN})")
    one.add_argument("--interval", default="60 seconds")
    one.add_argument("--follow", action="store_true", help="read the log that is being written, line by line (a mounted folder)")
    one.add_argument("--bound-hours", type=float, help="longest session in hours; older state is dropped")
    return out


def main(words=None):
    args = parser().parse_args(words)
    spark = SparkSession.builder.appName(f"wardlog {args.job}").getOrCreate()
    if args.job == "preprocess":
        jobs.preprocess(spark, args.logs, args.data, per_file=args.per_file, pattern=args.pattern).show(truncate=False)
    elif args.job == "explore":
        jobs.explore(spark, args.data)["summary"].show(1000, truncate=False)
    elif args.job == "train":
        jobs.train(spark, args.data).show(truncate=False)
    elif args.job == "evaluate":
        jobs.evaluate(spark, args.data, noise=args.noise, folds=args.folds, scale_scope=args.scale_scope).show(truncate=False)
    elif args.job == "report":
        for table in jobs.report(spark, args.data).values():
            table.show(1000, truncate=False)
    else:
        from wardlog.streaming.live import Journal, keep_running

        options = {"pattern": args.pattern or (S.LOG_FILE_PATTERN if args.follow else S.FINISHED_LOG_PATTERN), "interval": args.interval}
        if args.follow:
            options["follow"] = True
        if args.bound_hours:
            options["bound"] = timedelta(hours=args.bound_hours)
        spark.streams.addListener(Journal())
        keep_running(lambda: jobs.watch(spark, args.logs, args.data, **options))


if __name__ == "__main__":
    main()
