"""The jobs' original input files, derived by Spark from the driver's tables.

Each builder writes one input in the format its job reads (JSON comment
lines, page-count text, weather CSV, web-log text, document text, edge
lines) into the shared scratch folder, once per input table set and format
version; later calls read the stored files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import hour_key
from tessera.plans import data
from tessera.session import committed, hadoop_path, scratch_path

# Bump when a derivation changes, so stored inputs of an older form are not reused.
INPUT_VERSION = "3"


def _stored(spark: SparkSession, sf_dir: str, name: str, build, fmt: str) -> str:
    path = scratch_path(spark, "inputs", data.input_tag(spark, sf_dir), f"{name}-v{INPUT_VERSION}")
    if committed(spark, path):
        return path
    df = build()
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer.json(path)
    elif fmt == "csv":
        writer.csv(path)
    else:
        writer.text(path)
    return path


def comment_rows(events: DataFrame) -> DataFrame:
    """Comment records: author from the user, subreddit = event type, and a
    whole-number score centred near the median value (so scores of both
    signs occur and every subreddit's mean score is positive)."""
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author"),
        F.col("event_id").cast("string").alias("id"),
        (F.floor("value").cast("long") - F.lit(35)).alias("score"),
        F.col("event_type").alias("subreddit"),
    )


def pagecount_lines(events: DataFrame) -> DataFrame:
    """``hour language title views bytes`` lines: events per hour and page.

    Error events are special pages, clicks land on the main page, sign-ups
    are French pages; the rest are English pages named by type and user.
    """
    et, uid = F.col("event_type"), F.col("user_id").cast("string")
    title = (
        F.when(et == "error", F.concat(F.lit("Special:Error_"), uid))
        .when(et == "click", F.lit("Main_Page"))
        .otherwise(F.concat(et, F.lit("_"), uid))
    )
    language = F.when(et == "signup", F.lit("fr")).otherwise(F.lit("en"))
    counts = events.groupBy(
        hour_key("ts").alias("hour"), language.alias("language"), title.alias("title")
    ).agg(F.count(F.lit(1)).alias("views"), F.sum(F.floor("value").cast("long")).alias("bytes"))
    return counts.select(F.concat_ws(" ", "hour", "language", "title", "views", "bytes").alias("value"))


def edge_lines(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Adjacency text with one ``src: dst`` line per edge (no grouping by node)."""
    edges = data.order_graph(orders, customer)
    return edges.select(F.format_string("%d: %d", "src", "dst").alias("value"))


def comments_json(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "comments", lambda: comment_rows(data.table(spark, sf_dir, "events")), "json")


def comments_with_broken_lines(spark, sf_dir) -> str:
    """Comment lines of which those of error events were cut short."""
    def build() -> DataFrame:
        line = F.to_json(F.struct("author", "id", "score", "subreddit"))
        rows = comment_rows(data.table(spark, sf_dir, "events")).withColumn("value", line)
        return rows.select(F.when(F.col("subreddit") == "error", F.left("value", F.lit(20))).otherwise(F.col("value")).alias("value"))

    return _stored(spark, sf_dir, "comments-broken", build, "text")


def pagecount_files(spark, sf_dir) -> str:
    """Page counts as the job first got them: a file ``pagecounts-YYYYMMDD-HH0000`` per hour, the hour in its name only.

    Written a folder per hour and moved to their names one by one (there are
    as many as hours in the data); the folder gets its own name last, so one
    that is there is whole.
    """
    done = scratch_path(spark, "inputs", data.input_tag(spark, sf_dir), f"pagecount-files-v{INPUT_VERSION}")
    fs, place = hadoop_path(spark, done)
    if fs.exists(place):
        return done
    lines = pagecount_lines(data.table(spark, sf_dir, "events"))
    split = lines.select(F.substring_index("value", " ", 1).alias("hour"), F.expr("substring(value, instr(value, ' ') + 1)").alias("value"))
    staged = scratch_path(spark, "inputs", "staged", unique=True)
    split.repartition("hour").write.partitionBy("hour").text(f"{staged}/by-hour")
    named = hadoop_path(spark, f"{staged}/named")[1]
    fs.mkdirs(named)
    for folder in fs.listStatus(hadoop_path(spark, f"{staged}/by-hour")[1]):
        if folder.isDirectory():
            hour = folder.getPath().getName().split("=")[1]
            parts = sorted(f.getPath().toString() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            for n, part in enumerate(parts):
                fs.rename(hadoop_path(spark, part)[1], hadoop_path(spark, f"{staged}/named/pagecounts-{hour}0000" + (f"-{n}" if n else ""))[1])
    fs.mkdirs(place.getParent())
    if not fs.rename(named, place) and not fs.exists(place):
        raise OSError(f"{staged} could not be moved to {done}")
    return done


def pagecounts_text(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "pagecounts", lambda: pagecount_lines(data.table(spark, sf_dir, "events")), "text")


def weather_csv(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "weather",
                   lambda: data.weather_observations(data.table(spark, sf_dir, "events")), "csv")


def logs_text(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "logs", lambda: data.access_log_lines(data.table(spark, sf_dir, "events")), "text")


def documents_text(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "documents",
                   lambda: data.table(spark, sf_dir, "documents").select(F.col("text").alias("value")), "text")


def links_text(spark, sf_dir) -> str:
    return _stored(spark, sf_dir, "links",
                   lambda: edge_lines(data.table(spark, sf_dir, "orders"), data.table(spark, sf_dir, "customer")),
                   "text")


def points_text(spark, sf_dir) -> str:
    """``"x y"`` messages (quantity, extended price) of every line item."""
    return _stored(
        spark, sf_dir, "points",
        lambda: data.table(spark, sf_dir, "lineitem").select(
            F.concat_ws(" ", F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string")).alias("value")
        ),
        "text",
    )
