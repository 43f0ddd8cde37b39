"""End-to-end jobs J1-J23 as compositions of operators over the driver's tables.

Each job takes ``(spark, sf_dir)`` and returns a DataFrame (lazy unless the
job has to materialise state, such as the graph search or a stream). The
matching DuckDB SQL lives next to it in :mod:`tessera.plans.catalog`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.colour import lab_to_rgb, rgb_to_hsv, rgb_to_lab
from tessera.functions.text import base_name, hour_key_from_path, word_count_line
from tessera.operators import aggregate as agg
from tessera.operators import graph, joins, keyed
from tessera.operators.partition import spread_if_uneven
from tessera.operators.weather import readings, widest_range_per_date
from tessera.plans import data
from tessera.plans.inputs import INPUT_VERSION
from tessera.session import scratch_path
from tessera.sinks.keyed_store import KeyedStore
from tessera.sources.logs import host_visits, parse_access_log

# Rounding applied to double results so that engines with different
# summation orders agree on the compared digits.
DIGITS = 6


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return data.table(spark, sf_dir, name)


def _r(c, digits: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- J1 word count -----------------------------------------------------------

def _documents(spark, sf_dir):
    """Document texts as lines; spread over the cores first if the scan is
    badly split (tokenising is the heavy per-row work of the job)."""
    docs = _t(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return spread_if_uneven(docs)


def word_count(spark, sf_dir):
    """Occurrences of every word of every document, sorted by word."""
    return agg.word_count(_documents(spark, sf_dir)).orderBy("word")


def word_count_lines(spark, sf_dir):
    """J1 output as ``word n`` text lines."""
    counts = agg.word_count(_documents(spark, sf_dir))
    return counts.orderBy("word").select(word_count_line("word", "n").alias("line"))


# --- J2 average per group ---------------------------------------------------

def group_average(spark, sf_dir):
    """Count, total and mean of ``value`` per event type (partial aggregate)."""
    ev = _t(spark, sf_dir, "events")
    out = agg.group_mean(ev, "event_type", "value")
    return out.select("event_type", "n", _r("total", 2).alias("total"), _r("mean").alias("mean"))


# --- J3 / J4 / J5 most viewed per hour --------------------------------------

def hourly_max(spark, sf_dir):
    """Largest page-view count per hour, never below 0."""
    pc = data.pagecounts(_t(spark, sf_dir, "events"))
    return agg.group_max(pc, "hour", "views", out="max_views", floor=0).orderBy("hour")


def hourly_top_one(spark, sf_dir):
    """One most viewed page per hour; ties go to the largest title."""
    pc = data.pagecounts(_t(spark, sf_dir, "events"))
    return agg.argmax_one(pc, "hour", "views", tie="title").orderBy("hour")


def hourly_top_ties(spark, sf_dir, strategy: str = "auto"):
    """Every most viewed page per hour (ties kept), maxima joined back."""
    pc = data.pagecounts(_t(spark, sf_dir, "events"))
    top = joins.join_back_to_max(pc, "hour", "views", strategy=strategy)
    return top.select("hour", "title", "views").orderBy("hour", "title")


# --- J6 comment ETL split -----------------------------------------------------

def _etl_input(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.filter(F.col("event_type").contains("e")).select(
        "event_id", "user_id", "event_type", (F.col("value") - F.lit(50.0)).alias("score")
    )


def etl_positive(spark, sf_dir):
    """J6 branch: comments of subreddits containing ``e`` with a positive score."""
    return _etl_input(spark, sf_dir).filter(F.col("score") > 0)


def etl_negative(spark, sf_dir):
    """J6 branch: comments of subreddits containing ``e`` with a negative score."""
    return _etl_input(spark, sf_dir).filter(F.col("score") < 0)


def etl_predicates():
    """The J6 branch predicates, by output name."""
    return {"positive": F.col("score") > 0, "negative": F.col("score") < 0}


def etl_labelled(spark, sf_dir):
    """Both outputs of the split in one pass: rows labelled by branch (the write
    side of :func:`tessera.sinks.files.split_by` partitions by the label)."""
    src = _etl_input(spark, sf_dir)
    label = F.when(F.col("score") > 0, F.lit("positive")).when(F.col("score") < 0, F.lit("negative"))
    return src.withColumn("part", label).filter(F.col("part").isNotNull())


# --- J9 filtered projection ----------------------------------------------------

def flagged_projection(spark, sf_dir):
    """J9 on the part table: prefix, equality and NULL predicates, then a ``/10`` projection."""
    part = _t(spark, sf_dir, "part")
    kept = part.filter(
        F.col("p_name").isNotNull()
        & F.col("p_brand").startswith("Brand#1")
        & (F.col("p_type") == "ECONOMY")
    )
    return kept.select("p_partkey", "p_brand", (F.col("p_size") / 10).alias("size_tenths"))


def weather_etl(spark, sf_dir, prefix: str = "U1"):
    """J9 on observation rows: clean TMAX readings of stations with a name prefix, in degrees."""
    maxima = readings(_observations(spark, sf_dir), "TMAX", "tmax")
    return maxima.filter(F.col("station").startswith(prefix))


# --- J7 / J8 relative score ----------------------------------------------------

def _relative(spark, sf_dir, strategy):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    rel = joins.relative_to_group_mean(ev, "event_type", "value", out="relative_score", strategy=strategy)
    return rel.select("event_id", "user_id", "event_type", _r("relative_score").alias("relative_score")).orderBy(
        F.col("relative_score").desc(), "event_id"
    )


def relative_score(spark, sf_dir):
    """The detail rows and the group means meet in a shuffle (sort-merge) join."""
    return _relative(spark, sf_dir, "shuffle")


def relative_score_broadcast(spark, sf_dir):
    """The means are written once, measured, and broadcast; detail rows are not shuffled."""
    return _relative(spark, sf_dir, "broadcast")


# --- J10 / J11 largest daily range ----------------------------------------------

def _observations(spark, sf_dir):
    return data.weather_observations(_t(spark, sf_dir, "events"))


def daily_range_max(spark, sf_dir, strategy: str = "auto"):
    """Stations with the widest TMAX-TMIN range of each day (ties kept), 2-decimal text."""
    return widest_range_per_date(_observations(spark, sf_dir), strategy=strategy)


# One scan: equal readings are counted, a station's day has its highest TMAX and
# lowest TMIN with their counts, and a widest day is shown once for each pair.
DAILY_RANGE_SQL = """
WITH readings AS (
  SELECT station, date, observation = 'TMAX' AS high, value, count(*) AS n FROM {obs}
  WHERE qflag IS NULL AND observation IN ('TMAX', 'TMIN') GROUP BY ALL),
days AS (
  SELECT station, date, (max(value) FILTER (WHERE high) - min(value) FILTER (WHERE NOT high)) / 10 AS range,
    max_by(n, value) FILTER (WHERE high) * min_by(n, value) FILTER (WHERE NOT high) AS pairs
  FROM readings GROUP BY station, date)
SELECT date, station, round(range, 3) AS range
FROM (SELECT *, explode(sequence(1, pairs)) FROM days JOIN (SELECT date, max(range) AS range FROM days GROUP BY date) USING (date, range))
ORDER BY date, station
"""


def daily_range_max_sql(spark, sf_dir):
    """The same in Spark SQL, range rounded to 3 decimals."""
    return spark.sql(DAILY_RANGE_SQL, obs=_observations(spark, sf_dir))


# --- J12 / J13 / J15 web logs ----------------------------------------------------

def _log_lines(spark, sf_dir):
    return data.access_log_lines(_t(spark, sf_dir, "events"))


def access_log_parse(spark, sf_dir):
    """J15 parse: well-formed log lines as typed rows with a repeatable SHA-256 id."""
    return parse_access_log(_log_lines(spark, sf_dir), "value", id_mode="stable")


def _correlate(logs: DataFrame) -> DataFrame:
    per_host = host_visits(logs)
    r = agg.pearson(per_host, "visits", "bytes")
    return r.select(
        F.col("n").cast("long").alias("n"),
        F.col("sx").cast("long").alias("sum_x"),
        F.col("sy").cast("long").alias("sum_y"),
        _r("r").alias("r"),
        _r("r2").alias("r2"),
    )


def log_correlation(spark, sf_dir):
    """Pearson r and r² between requests and bytes per host, from moment sums."""
    return _correlate(parse_access_log(_log_lines(spark, sf_dir)))


def load_logs(spark, sf_dir, path: str | None = None, partitions: int | None = None) -> DataFrame:
    """Parse, key with a fresh UUID per row, replace the table keyed by host; its new version.

    The table has one place per input; the version before the last stays for those who still read it, older ones are freed.
    """
    store = KeyedStore(spark, path or scratch_path(spark, "tables", _tag(spark, sf_dir), "access_logs"), "host")
    logs = parse_access_log(_log_lines(spark, sf_dir), id_mode="random")
    loaded = store.replace(logs.repartition(partitions) if partitions else logs)
    store.vacuum(keep=2)
    return loaded


def loaded_logs(spark, sf_dir):
    """J15 read back: the loaded table without its random key, plus the key's length."""
    stored = load_logs(spark, sf_dir)
    return stored.select("host", "datetime", "path", "bytes", F.length("id").alias("id_length"))


def loaded_logs_total_bytes(spark, sf_dir):
    """Total bytes served, summed over the loaded log table (one row)."""
    stored = load_logs(spark, sf_dir)
    return agg.total(stored, "bytes", out="total_bytes").select(F.col("total_bytes").cast("long").alias("total_bytes"))


def log_table_correlation(spark, sf_dir):
    """The same correlation read back from the loaded keyed table."""
    return _correlate(load_logs(spark, sf_dir).select("host", "bytes"))


# --- J14 shortest path -------------------------------------------------------------

GRAPH_SOURCE = 1
GRAPH_MAX_HOPS = 6


def _paths(spark, sf_dir):
    edges = data.order_graph(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer"))
    return graph.shortest_paths(graph.stage_edges(edges, _tag(spark, sf_dir)), GRAPH_SOURCE, GRAPH_MAX_HOPS, staged=True)


def shortest_hops(spark, sf_dir):
    """``node, parent, dist`` of every node within 6 hops of node 1."""
    return _paths(spark, sf_dir).select("node", "parent", "dist")


def shortest_route(spark, sf_dir):
    """The route from node 1 to every reachable node, as text."""
    routes = graph.all_routes(_paths(spark, sf_dir), GRAPH_MAX_HOPS)
    return routes.select("node", "dist", F.array_join(F.col("path"), " ").alias("route"))


def routes_to_dearest(spark, sf_dir):
    """GRF2 / FLT11: routes from node 1 to the customers of the five dearest orders and to a node that no edge reaches."""
    orders = _t(spark, sf_dir, "orders")
    targets = [r[0] for r in orders.filter(F.col("o_orderkey").isin(dearest_orders(spark, sf_dir))).select("o_custkey").collect()]
    beyond = _t(spark, sf_dir, "customer").count()  # edges end below the number of customers
    found = graph.routes_to(_paths(spark, sf_dir), [*targets, beyond])
    wanted = spark.createDataFrame([(t,) for t in sorted({*targets, beyond})], "target long")
    return wanted.join(found, "target", "left").select(
        "target", F.coalesce(F.array_join("path", " "), F.lit(" ".join(graph.NO_PATH))).alias("route"))


# --- J16 / J17 / J18 orders and part names --------------------------------------------

def order_lines(spark, sf_dir):
    """``Order #k $p: names`` for every order, joining orders, line items and parts at query time."""
    o, li, p = (_t(spark, sf_dir, n) for n in ("orders", "lineitem", "part"))
    return keyed.order_lines(o, li, p).orderBy("o_orderkey")


def _denormalized(spark, sf_dir):
    o, li, p = (_t(spark, sf_dir, n) for n in ("orders", "lineitem", "part"))
    return keyed.denormalize_orders(o, li, p)


def orders_denormalized(spark, sf_dir):
    """Orders with the sorted set of their part names (as text for comparison)."""
    d = _denormalized(spark, sf_dir)
    return d.select(*[c for c in d.columns if c != "part_names"], F.array_join("part_names", ", ").alias("part_names"))


def _tag(spark: SparkSession, sf_dir: str) -> str:
    return data.input_tag(spark, sf_dir)


def orders_parts(spark, sf_dir, rebuild: bool = False) -> KeyedStore:
    """J17 output as a keyed store in the shared scratch folder; built once per input."""
    store = KeyedStore(spark, scratch_path(spark, "tables", _tag(spark, sf_dir), f"orders_parts-v{INPUT_VERSION}"), "o_orderkey")
    if rebuild or not store.exists():
        store.replace(_denormalized(spark, sf_dir))
    return store


def order_lines_denorm(spark, sf_dir, keys=None):
    """The order lines read from the stored denormalised table, no join; with ``keys``, from their buckets only."""
    store = orders_parts(spark, sf_dir)
    return keyed.lines_from_denormalized(store.read() if keys is None else store.lookup(keys)).orderBy("o_orderkey")


def dearest_orders(spark, sf_dir, n: int = 5) -> list[int]:
    """The keys of the ``n`` orders of the highest price: a key list taken from the data (a top-n report)."""
    top = _t(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(n)
    return [r["o_orderkey"] for r in top.select("o_orderkey").collect()]


def order_lines_by_key(spark, sf_dir):
    """J16 by key list: the lines of the five dearest orders, joined at query time."""
    o, li, p = (_t(spark, sf_dir, n) for n in ("orders", "lineitem", "part"))
    return keyed.order_lines(o, li, p, dearest_orders(spark, sf_dir)).orderBy("o_orderkey")


def order_lines_denorm_by_key(spark, sf_dir):
    """J18 by key list: the same lines looked up in the stored denormalised table."""
    return order_lines_denorm(spark, sf_dir, dearest_orders(spark, sf_dir))


def order_lines_urgent(spark, sf_dir):
    """FLT9 with keys of any number: lines of all urgent orders, their keys a DataFrame joined to the stored table."""
    keys = _t(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return order_lines_denorm(spark, sf_dir, keys)


# --- SNK8 upsert ------------------------------------------------------------------------

def _order_updates(orders: DataFrame) -> DataFrame:
    """Open orders get closed and re-priced (+100.00): an update batch taken from the data."""
    return orders.filter(F.col("o_orderstatus") == "O").withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + F.lit(100.0)}
    )


def upsert_orders(spark, sf_dir):
    """SNK8: an update batch written into the orders table, last write wins per key."""
    orders = _t(spark, sf_dir, "orders")
    return keyed.upsert_by_key(orders, _order_updates(orders), "o_orderkey")


def store_merge_orders(spark, sf_dir):
    """SNK8 on stored data: the orders as a keyed store, the update batch merged into the buckets that it touches, read back."""
    orders = _t(spark, sf_dir, "orders")
    store = KeyedStore(spark, scratch_path(spark, "tables", _tag(spark, sf_dir), "orders", unique=True), "o_orderkey")
    store.replace(orders)
    return store.merge(_order_updates(orders))


def upsert_versions(spark, sf_dir):
    """SNK8 with versions out of order: every line item re-prices its order at version
    ``l_linenumber``; stored orders are version 2, so later versions replace them and earlier ones don't."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", F.lit(2).alias("version"), F.col("o_totalprice").alias("price"))
    lines = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("int").alias("version"), F.col("l_extendedprice").alias("price"))
    return keyed.upsert_by_key(orders, lines, "o_orderkey", seq="version")


# --- AGG8 / AGG10 / J19 sums and line fits --------------------------------------------------

def global_sums(spark, sf_dir):
    """AGG8/AGG14: n, Σx, Σy, Σx², Σxy of quantity and price over all line items."""
    li = _t(spark, sf_dir, "lineitem")
    m = agg.moments(li, "l_quantity", "l_extendedprice")
    return m.select(
        F.col("n").cast("long").alias("n"),
        _r("sx", 2).alias("sum_x"),
        _r("sy", 2).alias("sum_y"),
        _r("sxx", 2).alias("sum_xx"),
        _r("sxy", 2).alias("sum_xy"),
    )


def linear_fit(spark, sf_dir):
    """AGG10: least-squares price on quantity over all line items."""
    li = _t(spark, sf_dir, "lineitem")
    fit = agg.linear_fit(li, "l_quantity", "l_extendedprice")
    return fit.select(F.col("n").cast("long").alias("n"), _r("slope").alias("slope"), _r("intercept").alias("intercept"))


def stream_linear_fit(spark, sf_dir):
    """The same fit kept up to date by a stream over the line-item files."""
    from tessera.streaming.regression import run_linear_fit_stream

    return run_linear_fit_stream(spark, sf_dir)


# --- FN14-FN17 colour conversions ---------------------------------------------------------

def rgb_to_lab_rows(spark, sf_dir):
    """FN14: LAB colour of every line item's byte-sized keys."""
    c = data.colours(_t(spark, sf_dir, "lineitem"))
    lab = rgb_to_lab(c)
    return lab.select("R", "G", "B", "word", *[_r(x).alias(x) for x in ("labL", "labA", "labB")])


def rgb_to_hsv_rows(spark, sf_dir):
    """FN15: HSV colour of every line item's byte-sized keys."""
    c = data.colours(_t(spark, sf_dir, "lineitem"))
    hsv = rgb_to_hsv(c)
    return hsv.select("R", "G", "B", "word", *[_r(x).alias(x) for x in ("H", "S", "V")])


def lab_roundtrip(spark, sf_dir):
    """RGB -> LAB -> RGB for every line item's colour (the inverse used by the grid)."""
    c = data.colours(_t(spark, sf_dir, "lineitem"))
    back = lab_to_rgb(rgb_to_lab(c), out_r="R2", out_g="G2", out_b="B2")
    return back.select("R", "G", "B", *[_r(x, 4).alias(x) for x in ("R2", "G2", "B2")])


# --- JOIN7 / FN13 yesterday pairs -------------------------------------------------------------

def yesterday_pairs(spark, sf_dir):
    """JOIN7: each station-day with the same station's previous day (gaps give no row)."""
    daily = data.daily_tmax(_t(spark, sf_dir, "events")).select("station", "date", "tmax")
    pairs = joins.with_previous_day(daily, "station", "date", "tmax")
    return pairs.select("station", "date", F.dayofyear("date").alias("dayofyear"), "tmax", "yesterday_tmax")


# --- FN3 / SRC6 hour key from a path ----------------------------------------------------------

def page_hour_key(spark, sf_dir):
    """FN3: base name of each page path and the hour key cut from it."""
    pages = _t(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        base_name("url").alias("file_name"),
        hour_key_from_path("url").alias("hour"),
    )
