"""Jobs J1-J23 on their original input formats, with IO at the edges.

Each runner reads files (or a keyed table, or a stream) under a declared
schema, composes the operators, writes the output and returns the result
DataFrame (or the computed values). ``python -m tessera <job> ...`` runs them
from the command line.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.text import key_value_line, word_count_line
from tessera.operators import aggregate as agg
from tessera.operators import graph, joins, keyed, ml
from tessera.operators.partition import hash_split, spread_if_uneven
from tessera.operators.weather import readings, widest_range_per_date
from tessera.plans.jobs import DAILY_RANGE_SQL
from tessera.sinks.files import (
    replace_table,
    split_by,
    to_json_lines,
    write_csv,
    write_json,
    write_lines,
)
from tessera.sinks.keyed_store import KeyedStore
from tessera.sources.files import BROKEN, parse_json, read_csv, read_delimited, read_json, read_lines, read_table, with_hour_from_file
from tessera.sources.graph_text import parse_adjacency
from tessera.sources.logs import host_visits, parse_access_log
from tessera.streaming.regression import file_stream, kafka_stream, parse_points, running_fit, start_stream

# --- fixed values: page-count filter (English pages, not the main or special pages) ---
PAGE_LANGUAGE = "en"
MAIN_PAGE = "Main_Page"
SPECIAL_PREFIX = "Special:"


def _pages_filter(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.col("language") == PAGE_LANGUAGE)
        & (F.col("title") != MAIN_PAGE)
        & ~F.col("title").startswith(SPECIAL_PREFIX)
    )


# J1 -------------------------------------------------------------------------

def word_count(spark: SparkSession, inputs: str, output: str, rebalance: int | None = None,
               unicode_blanks: bool = False) -> DataFrame:
    """Text files -> ``word count`` lines sorted by word.

    ``rebalance`` spreads the lines over that many partitions; without it the
    lines are spread only when the scan is badly split (e.g. a few big gzip files).
    """
    lines = read_lines(spark, inputs, rebalance) if rebalance else spread_if_uneven(read_lines(spark, inputs), splits_hold_rows=True)
    counts = agg.word_count(lines, "value", unicode_blanks).orderBy("word")
    write_lines(counts.select(word_count_line("word", "n").alias("value")), output)
    return counts


# J2 -------------------------------------------------------------------------

def group_average(spark: SparkSession, inputs: str, output: str, fmt: str = "csv") -> DataFrame:
    """Comment JSON -> average score per subreddit (CSV, ``key<TAB>avg`` or JSON arrays)."""
    means = agg.group_mean(read_json(spark, inputs, schemas.COMMENT), "subreddit", "score")
    out = means.select("subreddit", F.col("mean").alias("average"))
    if fmt == "csv":
        write_csv(out, output)
    elif fmt == "kv":
        write_lines(out.select(key_value_line("subreddit", "average").alias("value")), output)
    else:
        write_lines(to_json_lines(out, as_array=True), output)
    return out


# J3 / J4 / J5 ----------------------------------------------------------------

def hourly_max_views(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """Page counts with the hour in the line -> ``hour<TAB>max views`` (never below 0)."""
    pages = _pages_filter(read_delimited(spark, inputs, schemas.PAGECOUNT_WITH_HOUR))
    out = agg.group_max(pages, "hour", "views", out="views", floor=0).orderBy("hour")
    write_lines(out.select(key_value_line("hour", "views").alias("value")), output)
    return out


def hourly_top_page(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """Page counts with the hour in the line -> one most viewed page per hour
    (ties to the largest title), ``hour<TAB>[views, 'title']``."""
    pages = _pages_filter(read_delimited(spark, inputs, schemas.PAGECOUNT_WITH_HOUR))
    out = agg.argmax_one(pages, "hour", "views", "title").orderBy("hour")
    line = F.format_string("%s\t[%d, '%s']", "hour", "views", "title")
    write_lines(out.select(line.alias("value")), output)
    return out


def hourly_top_pages(spark: SparkSession, inputs: str, output: str, strategy: str = "auto",
                     hour_in_line: bool = False) -> DataFrame:
    """Page-count files named ``pagecounts-YYYYMMDD-HH....`` (or, with
    ``hour_in_line``, lines that start with the hour) -> every most viewed page
    per hour (ties kept) as JSON, sorted by hour and title."""
    if hour_in_line:
        pages = read_delimited(spark, inputs, schemas.PAGECOUNT_WITH_HOUR)
    else:
        pages = with_hour_from_file(read_delimited(spark, inputs, schemas.PAGECOUNT))
    pages = _pages_filter(pages).select("hour", "title", "views")
    out = joins.join_back_to_max(pages, "hour", "views", strategy=strategy).select("hour", "title", "views")
    out = out.orderBy("hour", "title")
    write_json(out, output)
    return out


# J6 -------------------------------------------------------------------------

def comment_split(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """Comments of subreddits containing ``e``: positive and negative scores to
    ``<output>/part=positive`` and ``.../part=negative`` in one pass."""
    kept = read_json(spark, inputs, schemas.COMMENT).select("author", "score", "subreddit")
    kept = kept.filter(F.col("subreddit").contains("e"))
    split_by(kept, output, {"positive": F.col("score") > 0, "negative": F.col("score") < 0})
    return kept


def comment_quarantine(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """Comment lines, read once: good ones as JSON in ``<output>/part=good``, broken ones as they are in ``<output>/part=broken``
    (field ``broken_line``), so that a broken line is neither lost nor a comment without a subreddit."""
    rows = parse_json(read_lines(spark, inputs), "value", schemas.COMMENT, keep_broken=True)
    rows = rows.select("author", "score", "subreddit", BROKEN)
    rows = rows.withColumn("part", F.when(F.col(BROKEN).isNull(), F.lit("good")).otherwise(F.lit("broken")))
    rows.write.mode("overwrite").partitionBy("part").json(output)
    return spark.read.schema(f"author string, score long, subreddit string, {BROKEN} string, part string").json(output)


# J7 / J8 ---------------------------------------------------------------------

def relative_score(spark: SparkSession, inputs: str, output: str, strategy: str = "auto") -> DataFrame:
    """Each comment's score over its subreddit's mean (mean > 0), JSON arrays
    ``["author", score]`` sorted by the relative score, largest first."""
    comments = read_json(spark, inputs, schemas.COMMENT).select("author", "subreddit", "score", "id")
    rel = joins.relative_to_group_mean(comments, "subreddit", "score", out="relative", strategy=strategy)
    # the id is unique: a run of equal scores of one author can be split over tasks
    out = rel.orderBy(F.col("relative").desc(), "author", "id").select("author", "relative")
    write_lines(to_json_lines(out, as_array=True), output)
    return out


# J9 / J10 / J11 --------------------------------------------------------------

def weather_etl(spark: SparkSession, inputs: str, output: str, prefix: str = "CA") -> DataFrame:
    """Clean TMAX observations of stations with a name prefix, degrees, gzip JSON."""
    maxima = readings(read_csv(spark, inputs, schemas.OBSERVATION), "TMAX", "tmax")
    out = maxima.filter(F.col("station").startswith(prefix))
    write_json(out, output, compression="gzip")
    return out


def temp_range(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """Stations with the largest daily range per date (ties kept), CSV."""
    out = widest_range_per_date(read_csv(spark, inputs, schemas.OBSERVATION))
    write_csv(out, output)
    return out


def temp_range_sql(spark: SparkSession, inputs: str, output: str) -> DataFrame:
    """The same in SQL (range rounded to 3 decimals)."""
    out = spark.sql(DAILY_RANGE_SQL, obs=read_csv(spark, inputs, schemas.OBSERVATION))
    write_csv(out, output)
    return out


# J12 / J13 / J15 -------------------------------------------------------------

def _r_of(per_host: DataFrame) -> dict:
    row = agg.pearson(per_host, "visits", "bytes").first()
    return {"n": row.n, "sum_x": row.sx, "sum_y": row.sy, "sum_x2": row.sxx, "sum_y2": row.syy,
            "sum_xy": row.sxy, "r": row.r, "r2": row.r2}


def correlate_logs(spark: SparkSession, inputs: str) -> dict:
    """Access logs -> r and r² between requests and bytes per host."""
    return _r_of(host_visits(parse_access_log(read_lines(spark, inputs))))


def correlate_logs_table(spark: SparkSession, table: str, fmt: str = "parquet", **options) -> dict:
    """The same from a loaded keyed table (host, bytes)."""
    store = KeyedStore(spark, table, "host")
    logs = store.read() if fmt == "parquet" and store.exists() else read_table(spark, table, fmt, **options)
    return _r_of(host_visits(logs.select("host", "bytes")))


def load_logs(spark: SparkSession, inputs: str, table: str, partitions: int | None = None,
              fmt: str = "parquet", **options) -> DataFrame:
    """Access logs -> table keyed by host (host, id, datetime, path, bytes), replaced on load.

    A Parquet table is a keyed store, whose old rows stay readable until the
    new ones are all written; other formats are overwritten by their writer.
    """
    logs = parse_access_log(read_lines(spark, inputs), id_mode="random")
    logs = logs.repartition(partitions) if partitions else logs
    if fmt == "parquet":
        return KeyedStore(spark, table, "host").replace(logs)
    replace_table(logs.hint("rebalance"), table, fmt, **options)
    return read_table(spark, table, fmt, **options)


# J14 -------------------------------------------------------------------------

def shortest_path(spark: SparkSession, inputs: str, output: str, source: int, target: int | Sequence[int],
                  max_hops: int = 6, links_file: str | None = "links-simple-sorted.txt") -> list:
    """Adjacency lists (``<inputs>/links-simple-sorted.txt``, or ``inputs`` itself
    when ``links_file`` is None) -> ``(node, (parent, dist))`` lines in
    ``<output>/dist`` and the route to ``target`` in ``<output>/path``, a node
    a line (``NO PATH FOUND`` when there is none). Several targets give a line
    ``target: nodes`` each, and a list of lists. Each round's new nodes stay in
    ``<output>/iter-<i>``."""
    path = inputs if (links_file is None or inputs.endswith(".txt")) else f"{inputs.rstrip('/')}/{links_file}"
    edges = parse_adjacency(read_lines(spark, path))
    paths = graph.shortest_paths(edges, source, max_hops, rounds_path=output)
    parent = F.coalesce(F.col("parent").cast("string"), F.lit("-"))
    table = paths.orderBy("node").select(F.format_string("(%d, (%s, %d))", "node", parent, "dist").alias("value"))
    write_lines(table, f"{output}/dist")
    targets = [target] if isinstance(target, int) else list(target)
    found = {r["target"]: list(r["path"]) for r in graph.routes_to(paths, targets).collect()}
    routes = [found.get(t, list(graph.NO_PATH)) for t in targets]
    lines = [str(x) for x in routes[0]] if isinstance(target, int) else [f"{t}: {' '.join(map(str, r))}" for t, r in zip(targets, routes)]
    write_lines(spark.createDataFrame([(x,) for x in lines], "value string"), f"{output}/path", single_file=True)
    return routes[0] if isinstance(target, int) else routes


# J16 / J17 / J18 ---------------------------------------------------------------

def order_lines(spark: SparkSession, tables: str, output: str, keys: Sequence[int] | None = None,
                names: tuple[str, str, str] = ("orders", "lineitem", "part")) -> DataFrame:
    """Orders (by key) with their part names, joined at query time, as text lines."""
    o, li, p = (spark.read.parquet(f"{tables.rstrip('/')}/{n}") for n in names)
    out = keyed.order_lines(_tpch_cols(o, "o"), _tpch_cols(li, "l"), _tpch_cols(p, "p"), keys).orderBy("o_orderkey")
    write_lines(out.select("line"), output)
    return out


def denormalize_orders(spark: SparkSession, tables: str, output: str,
                       names: tuple[str, str, str] = ("orders", "lineitem", "part")) -> DataFrame:
    """orders ⋈ lineitem ⋈ part -> orders with ``part_names``, merged into the
    keyed table at ``output`` (rows with an existing key replace it).

    The table is a :class:`~tessera.sinks.keyed_store.KeyedStore`: a load
    rewrites the buckets of its keys, and one that dies changes nothing.
    """
    o, li, p = (spark.read.parquet(f"{tables.rstrip('/')}/{n}") for n in names)
    denorm = keyed.denormalize_orders(_tpch_cols(o, "o"), _tpch_cols(li, "l"), _tpch_cols(p, "p"))
    return KeyedStore(spark, output, "o_orderkey").merge(denorm)


def order_lines_denormalized(spark: SparkSession, table: str, output: str,
                             keys: Sequence[int] | None = None) -> DataFrame:
    """Order lines read from the denormalised table (no join); with ``keys``, from their buckets only."""
    store = KeyedStore(spark, table, "o_orderkey")
    out = keyed.lines_from_denormalized(store.read() if keys is None else store.lookup(keys)).orderBy("o_orderkey")
    write_lines(out.select("line"), output)
    return out


def _tpch_cols(df: DataFrame, prefix: str) -> DataFrame:
    """Accept both ``orderkey`` and ``o_orderkey`` style column names."""
    renamed = {c: f"{prefix}_{c}" for c in df.columns if not c.startswith(f"{prefix}_")}
    return df.withColumnsRenamed(renamed) if renamed else df


# J19 -------------------------------------------------------------------------

def stream_regression(spark: SparkSession, source: str, timeout_s: float = 600.0, servers: str | None = None,
                      sink: str = "console", mode: str = "update", available_now: bool = False, **options):
    """``"x y"`` messages from a Kafka topic (``servers`` given) or a text folder
    -> running slope and intercept, printed in update mode until ``timeout_s``."""
    msgs = kafka_stream(spark, servers, source) if servers else file_stream(spark, source, "value string", fmt="text")
    fit = running_fit(parse_points(msgs)).select(F.col("slope").alias("BETA"), F.col("intercept").alias("ALPHA"))
    query = start_stream(fit, mode=mode, sink=sink, available_now=available_now, **options)
    query.awaitTermination(timeout_s)
    query.stop()
    return query


# J20 -------------------------------------------------------------------------

def colour_predict(spark: SparkSession, inputs: str, output: str | None = None, seed: int = 123,
                   grid_resolution: int = 256) -> dict:
    """Colour CSV -> validation accuracy of the RGB and the LAB perceptron; with
    ``output``, each model's predictions over a LAB slice are written as Parquet."""
    data = read_csv(spark, inputs, schemas.COLOUR)
    n_labels = data.select("word").distinct().count()
    train, validation = hash_split(data, ["R", "G", "B", "word", "confidence"], (0.75, 0.25), seed=seed)
    train = ml.training_set(train)

    def fit(space: str):
        model = ml.colour_pipeline(space, n_labels=n_labels, seed=seed).fit(train)
        if output:
            ml.prediction_grid(spark, model, resolution=grid_resolution).write.mode("overwrite").parquet(
                f"{output}/predictions-{space}"
            )
        return space, ml.accuracy(model.transform(validation))

    scores = dict(ml.fit_concurrently(fit, ("rgb", "lab")))
    train.unpersist()
    return scores


# J21 / J22 / J23 -------------------------------------------------------------

def weather_train(spark: SparkSession, inputs: str, model_path: str, seed: int = 123,
                  with_yesterday: bool = True) -> dict:
    """Daily maxima CSV -> forest trained on 75 % of the stations, validation
    r² and RMSE, model saved (overwrite)."""
    data = read_csv(spark, inputs, schemas.TMAX)
    train, validation = hash_split(data, "station", (0.75, 0.25), seed=seed)
    train = ml.training_set(train)
    model = ml.tmax_pipeline(with_yesterday=with_yesterday, seed=seed).fit(train)
    metrics = ml.regression_metrics(model.transform(validation))
    ml.save_model(model, model_path)
    train.unpersist()
    return metrics


def weather_test(spark: SparkSession, model_path: str, inputs: str) -> dict:
    """A saved model scored on another daily-maxima CSV: r², RMSE, importances."""
    model = ml.load_model(model_path)
    metrics = ml.regression_metrics(model.transform(read_csv(spark, inputs, schemas.TMAX)))
    metrics["importances"] = {r.feature: r.importance for r in ml.feature_importances(spark, model).collect()}
    return metrics


def weather_tomorrow(spark: SparkSession, model_path: str, station: str, latitude: float, longitude: float,
                     elevation: float, today: dt.date, today_tmax: float) -> float:
    """Predicted maximum for the day after ``today`` at one station."""
    model = ml.load_model(model_path)
    tomorrow = today + dt.timedelta(days=1)
    rows = [
        (station, today, latitude, longitude, elevation, today_tmax),
        (station, tomorrow, latitude, longitude, elevation, None),
    ]
    scored = model.transform(spark.createDataFrame(rows, schemas.TMAX))
    return scored.filter(F.col("date") == F.lit(tomorrow)).select("prediction").first()[0]
