"""Command line: ``python -m tessera <job> [arguments]``.

Examples::

    python -m tessera word_count in/ out/
    python -m tessera relative_score comments/ out/ --strategy broadcast
    python -m tessera shortest_path graph/ out/ 1 6
    python -m tessera order_lines tables/ out/ --keys 151201 986499
    python -m tessera weather_train tmax-1/ model/
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tessera.plans import file_jobs as J
from tessera.session import get_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    def io(name, **kw):
        s = sub.add_parser(name, **kw)
        s.add_argument("inputs")
        s.add_argument("output")
        return s

    io("word_count").add_argument("--rebalance", type=int, default=None)
    io("group_average").add_argument("--fmt", choices=["csv", "kv", "json"], default="csv")
    io("hourly_max_views")
    io("hourly_top_page")
    io("hourly_top_pages").add_argument("--strategy", default="broadcast")
    io("comment_split")
    io("relative_score").add_argument("--strategy", default="auto", choices=["auto", "broadcast", "shuffle"])
    io("weather_etl").add_argument("--prefix", default="CA")
    io("temp_range")
    io("temp_range_sql")
    s = sub.add_parser("correlate_logs")
    s.add_argument("inputs")
    s = sub.add_parser("correlate_logs_table")
    s.add_argument("table")
    s = io("load_logs")
    s.add_argument("--partitions", type=int, default=None)
    s = io("shortest_path")
    s.add_argument("source", type=int)
    s.add_argument("target", type=int)
    s.add_argument("--max-hops", type=int, default=6)
    s = io("order_lines")
    s.add_argument("--keys", type=int, nargs="*", default=None)
    io("denormalize_orders")
    s = io("order_lines_denormalized")
    s.add_argument("--keys", type=int, nargs="*", default=None)
    s = sub.add_parser("stream_regression")
    s.add_argument("source", help="Kafka topic (with --servers) or a folder of text files")
    s.add_argument("--servers", default=None)
    s.add_argument("--timeout", type=float, default=600.0)
    s = sub.add_parser("colour_predict")
    s.add_argument("inputs")
    s.add_argument("--output", default=None)
    s = sub.add_parser("weather_train")
    s.add_argument("inputs")
    s.add_argument("model")
    s = sub.add_parser("weather_test")
    s.add_argument("model")
    s.add_argument("inputs")
    s = sub.add_parser("weather_tomorrow")
    for name in ("model", "station"):
        s.add_argument(name)
    for name in ("latitude", "longitude", "elevation"):
        s.add_argument(name, type=float)
    s.add_argument("today", type=dt.date.fromisoformat)
    s.add_argument("today_tmax", type=float)
    return p


def main(argv=None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session(args.master, app_name=f"tessera {args.job}")
    job = args.job
    if job == "correlate_logs":
        result = J.correlate_logs(spark, args.inputs)
    elif job == "correlate_logs_table":
        result = J.correlate_logs_table(spark, args.table)
    elif job == "load_logs":
        result = J.load_logs(spark, args.inputs, args.output, args.partitions).count()
    elif job == "shortest_path":
        result = J.shortest_path(spark, args.inputs, args.output, args.source, args.target, args.max_hops)
    elif job == "stream_regression":
        J.stream_regression(spark, args.source, args.timeout, args.servers)
        result = "stopped"
    elif job == "colour_predict":
        result = J.colour_predict(spark, args.inputs, args.output)
    elif job == "weather_train":
        result = J.weather_train(spark, args.inputs, args.model)
    elif job == "weather_test":
        result = J.weather_test(spark, args.model, args.inputs)
    elif job == "weather_tomorrow":
        result = J.weather_tomorrow(spark, args.model, args.station, args.latitude, args.longitude,
                                    args.elevation, args.today, args.today_tmax)
    else:
        extra = {k: v for k, v in vars(args).items() if k not in ("job", "master", "inputs", "output")}
        getattr(J, job)(spark, args.inputs, args.output, **extra)
        result = "written"
    print(json.dumps(result, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
