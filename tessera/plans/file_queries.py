"""Registered queries that run the file-level jobs end to end.

Each query derives its job's original input files from the driver's tables
(once, :mod:`tessera.plans.inputs`), runs the job from
:mod:`tessera.plans.file_jobs` into a fresh output folder, and returns what the
job wrote, read back: the check then covers the readers, the operators and
the writers. Doubles are rounded when read back, as in the other queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.order import order_audit
from tessera.plans import file_jobs as J
from tessera.plans import inputs
from tessera.plans.jobs import dearest_orders
from tessera.session import scratch_path

DIGITS = 6


def _out(spark, name: str) -> str:
    return scratch_path(spark, "outputs", name, unique=True)


def _lines(spark, path: str):
    return spark.read.text(path).withColumnRenamed("value", "line")


def file_word_count(spark, sf_dir):
    out = _out(spark, "word_count")
    J.word_count(spark, inputs.documents_text(spark, sf_dir), out)
    return _lines(spark, out)


def file_group_average(spark, sf_dir):
    out = _out(spark, "group_average")
    J.group_average(spark, inputs.comments_json(spark, sf_dir), out, fmt="csv")
    back = spark.read.schema("subreddit string, average double").csv(out)
    return back.select("subreddit", F.round("average", DIGITS).alias("average"))


def file_comment_split(spark, sf_dir):
    out = _out(spark, "comment_split")
    J.comment_split(spark, inputs.comments_json(spark, sf_dir), out)
    return spark.read.schema("author string, score long, subreddit string, part string").json(out)


def file_relative_score(spark, sf_dir):
    out = _out(spark, "relative_score")
    J.relative_score(spark, inputs.comments_json(spark, sf_dir), out, strategy="broadcast")
    lines = spark.read.text(out)
    return lines.select(
        F.get_json_object("value", "$[0]").alias("author"),
        F.round(F.get_json_object("value", "$[1]").cast("double"), DIGITS).alias("relative"),
    )


def file_hourly_max_views(spark, sf_dir):
    out = _out(spark, "hourly_max_views")
    J.hourly_max_views(spark, inputs.pagecounts_text(spark, sf_dir), out)
    return _lines(spark, out)


def file_hourly_top_page(spark, sf_dir):
    out = _out(spark, "hourly_top_page")
    J.hourly_top_page(spark, inputs.pagecounts_text(spark, sf_dir), out)
    return _lines(spark, out)


def file_hourly_top_pages(spark, sf_dir, strategy: str = "broadcast"):
    """J5 on page-count lines: all most viewed pages per hour, ties kept."""
    out = _out(spark, "hourly_top_pages")
    J.hourly_top_pages(spark, inputs.pagecounts_text(spark, sf_dir), out, strategy=strategy, hour_in_line=True)
    return spark.read.schema("hour string, title string, views long").json(out)


def file_weather_etl(spark, sf_dir):
    out = _out(spark, "weather_etl")
    J.weather_etl(spark, inputs.weather_csv(spark, sf_dir), out, prefix="U1")
    return spark.read.schema("station string, date string, tmax double").json(out)


def file_temp_range(spark, sf_dir):
    out = _out(spark, "temp_range")
    J.temp_range(spark, inputs.weather_csv(spark, sf_dir), out)
    return spark.read.schema("date string, station string, range string").csv(out)


def file_temp_range_sql(spark, sf_dir):
    out = _out(spark, "temp_range_sql")
    J.temp_range_sql(spark, inputs.weather_csv(spark, sf_dir), out)
    return spark.read.schema("date string, station string, range double").csv(out)


def file_correlate_logs(spark, sf_dir):
    r = J.correlate_logs(spark, inputs.logs_text(spark, sf_dir))
    row = [(int(r["n"]), int(r["sum_x"]), int(r["sum_y"]), r["r"], r["r2"])]
    df = spark.createDataFrame(row, "n long, sum_x long, sum_y long, r double, r2 double")
    return df.select("n", "sum_x", "sum_y", F.round("r", DIGITS).alias("r"), F.round("r2", DIGITS).alias("r2"))


def file_load_logs(spark, sf_dir):
    table = J.load_logs(spark, inputs.logs_text(spark, sf_dir), _out(spark, "access_logs"))
    return table.select("host", "datetime", "path", "bytes", F.length("id").alias("id_length"))


_TPCH = ("orders.parquet", "lineitem.parquet", "part.parquet")


def file_order_lines(spark, sf_dir):
    out = _out(spark, "order_lines")
    J.order_lines(spark, sf_dir, out, names=_TPCH)
    return _lines(spark, out)


def file_order_lines_denormalized(spark, sf_dir):
    table, out = _out(spark, "orders_parts"), _out(spark, "order_lines_denorm")
    J.denormalize_orders(spark, sf_dir, table, names=_TPCH)
    J.order_lines_denormalized(spark, table, out)
    return _lines(spark, out)


def _links_job(spark, sf_dir) -> str:
    """J14 from node 1 to the customers of the dearest orders (reached) and to the first number past all nodes (not reached)."""
    out = _out(spark, "shortest_path")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter(F.col("o_orderkey").isin(dearest_orders(spark, sf_dir)))
    targets = sorted({r[0] for r in orders.select("o_custkey").collect()} | {spark.read.parquet(f"{sf_dir}/customer.parquet").count()})
    J.shortest_path(spark, inputs.links_text(spark, sf_dir), out, source=1, target=targets, links_file=None)
    return out


def file_shortest_path(spark, sf_dir):
    return _lines(spark, f"{_links_job(spark, sf_dir)}/dist")


def file_shortest_routes(spark, sf_dir):
    """The route lines that J14 writes, a reached and an unreached target among them."""
    return _lines(spark, f"{_links_job(spark, sf_dir)}/path")


def file_stream_regression(spark, sf_dir):
    """J19 over a text file stream: messages parsed, running fit, last update kept."""
    from tessera.streaming.regression import file_stream, parse_points, run_to_table, running_fit

    msgs = file_stream(spark, inputs.points_text(spark, sf_dir), "value string", fmt="text")
    fit = running_fit(parse_points(msgs))
    last = run_to_table(fit, _out(spark, "stream_regression"))
    return last.select(
        F.col("n").cast("long").alias("n"),
        F.round("slope", DIGITS).alias("slope"),
        F.round("intercept", DIGITS).alias("intercept"),
    )


def stream_store_totals(spark, sf_dir):
    """STR3 / SNK9: running totals per host, file by file, in update mode into a keyed store that the stream goes on with.

    The derived access-log files arrive one per batch; the stream is
    run twice on one checkpoint, the second time on what is left (nothing, if
    the first run saw all).
    """
    from tessera.sinks.keyed_store import KeyedStore
    from tessera.sources.logs import parse_access_log
    from tessera.streaming.regression import file_stream, run_to_store, running_totals

    source = inputs.logs_text(spark, sf_dir)
    place = _out(spark, "stream_totals")
    store = KeyedStore(spark, f"{place}/table", "host", buckets=16)
    for _ in range(2):
        lines = file_stream(spark, source, "value string", fmt="text", maxFilesPerTrigger=1)
        totals = running_totals(parse_access_log(lines), "host", "bytes")
        table = run_to_store(totals, store, f"{place}/checkpoint")
    return table.select("host", "n", "total")


def file_hourly_top_pages_by_name(spark, sf_dir):
    """J5 as the job first ran: the hour is taken from the names of the page-count files (SRC6, FN3)."""
    out = _out(spark, "hourly_top_pages_by_name")
    J.hourly_top_pages(spark, inputs.pagecount_files(spark, sf_dir), out)
    return spark.read.schema("hour string, title string, views long").json(out)


def file_comment_quarantine(spark, sf_dir):
    """SRC2, SRC3: good comments and broken lines, each in its own output."""
    out = J.comment_quarantine(spark, inputs.comments_with_broken_lines(spark, sf_dir), _out(spark, "comment_quarantine"))
    return out.select("author", "score", "subreddit", "broken_line", "part")


def file_broken_log_lines(spark, sf_dir):
    """SRC7: the lines that the log job leaves out."""
    from tessera.sources.files import read_lines
    from tessera.sources.logs import unparsed_log_lines

    return unparsed_log_lines(read_lines(spark, inputs.logs_text(spark, sf_dir)))


def file_order_audit(spark, sf_dir):
    """SRT1-SRT3: the sorted outputs of four jobs, audited as they lie in their files."""
    def audited(job, written, key):
        return order_audit(written, key).select(F.lit(job).alias("job"), "n", "inversions")

    words, pages, scores, ranges = (_out(spark, f"audit_{name}") for name in ("words", "pages", "scores", "ranges"))
    J.word_count(spark, inputs.documents_text(spark, sf_dir), words)
    J.hourly_top_pages(spark, inputs.pagecounts_text(spark, sf_dir), pages, hour_in_line=True)
    J.relative_score(spark, inputs.comments_json(spark, sf_dir), scores)
    J.temp_range(spark, inputs.weather_csv(spark, sf_dir), ranges)
    out = audited("word_count", spark.read.text(words), F.substring_index("value", " ", 1))
    out = out.unionByName(audited("hourly_top_pages", spark.read.schema("hour string, title string, views long").json(pages), F.struct("hour", "title")))
    relative = F.get_json_object("value", "$[1]").cast("double")
    out = out.unionByName(audited("relative_score", spark.read.text(scores), F.struct((-relative).alias("relative"), F.get_json_object("value", "$[0]").alias("author"))))
    return out.unionByName(audited("temp_range", spark.read.schema("date string, station string, range string").csv(ranges), F.struct("date", "station")))


FILE_QUERIES = {
    "file_word_count": file_word_count,
    "file_group_average": file_group_average,
    "file_comment_split": file_comment_split,
    "file_relative_score": file_relative_score,
    "file_hourly_max_views": file_hourly_max_views,
    "file_hourly_top_page": file_hourly_top_page,
    "file_hourly_top_pages": file_hourly_top_pages,
    "file_weather_etl": file_weather_etl,
    "file_temp_range": file_temp_range,
    "file_temp_range_sql": file_temp_range_sql,
    "file_correlate_logs": file_correlate_logs,
    "file_load_logs": file_load_logs,
    "file_order_lines": file_order_lines,
    "file_order_lines_denormalized": file_order_lines_denormalized,
    "file_shortest_path": file_shortest_path,
    "file_shortest_routes": file_shortest_routes,
    "file_stream_regression": file_stream_regression,
    "stream_store_totals": stream_store_totals,
    "file_hourly_top_pages_by_name": file_hourly_top_pages_by_name,
    "file_comment_quarantine": file_comment_quarantine,
    "file_broken_log_lines": file_broken_log_lines,
    "file_order_audit": file_order_audit,
}
