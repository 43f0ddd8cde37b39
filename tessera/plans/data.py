"""Inputs of the jobs, derived by Spark from the driver's tables.

The jobs were written for comment dumps, page counts, weather records, web
logs and link lists. These builders derive the same shapes from the
TPC-H-like tables so every job runs over whole tables and its work grows with
them. Every builder is a plain DataFrame transformation (no driver data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.colour import nearest_word
from tessera.functions.text import day_key, format_log_time, hour_key
from tessera.session import file_key
from tessera.sources.files import read_testdata


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_testdata(spark, sf_dir, name)


def input_tag(spark: SparkSession, sf_dir: str) -> str:
    """Short tag of an input folder for naming derived tables in the scratch folder.

    Made of the files' paths, lengths and times on any store, so derived
    tables are rebuilt when the inputs change.
    """
    return file_key(spark, sf_dir)[:12]


def pagecounts(events: DataFrame) -> DataFrame:
    """Page-count rows ``hour, title, views``: events per (hour, user), errors excluded.

    ``hour`` is the ``YYYYMMDD-HH`` key, ``title`` the user id, ``views`` the
    number of events of that user in that hour.
    """
    return (
        events.filter(F.col("event_type") != "error")
        .groupBy(hour_key("ts").alias("hour"), F.col("user_id").alias("title"))
        .agg(F.count(F.lit(1)).alias("views"))
    )


def station_of(user_id) -> F.Column:
    return F.concat(F.lit("U"), F.col(user_id).cast("string"))


def weather_observations(events: DataFrame) -> DataFrame:
    """Observation rows (station, date, observation, value, mflag, qflag, sflag, obstime).

    One TMAX and one TMIN row per (user, day): the day's largest and smallest
    event value in tenths. A day with a single event gets quality flag ``I``
    (insufficient), so the quality filter has something to drop.
    """
    daily = events.groupBy(
        station_of("user_id").alias("station"), day_key("ts").alias("date")
    ).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"), F.count(F.lit(1)).alias("n")
    )
    tenths = lambda c: F.floor(F.col(c) * F.lit(10.0)).cast("int")
    pairs = F.explode(
        F.array(
            F.struct(F.lit("TMAX").alias("observation"), tenths("hi").alias("value")),
            F.struct(F.lit("TMIN").alias("observation"), tenths("lo").alias("value")),
        )
    ).alias("o")
    none = F.lit(None).cast("string")
    return daily.select("station", "date", "n", pairs).select(
        "station",
        "date",
        F.col("o.observation").alias("observation"),
        F.col("o.value").alias("value"),
        none.alias("mflag"),
        F.when(F.col("n") < 2, F.lit("I")).alias("qflag"),
        none.alias("sflag"),
        none.alias("obstime"),
    )


def daily_tmax(events: DataFrame) -> DataFrame:
    """Daily maxima with position: station, date, latitude, longitude, elevation, tmax."""
    uid = F.col("user_id")
    return events.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        (F.max("value") / F.lit(10.0)).cast("float").alias("tmax")
    ).select(
        station_of("user_id").alias("station"),
        "date",
        (F.pmod(uid * 7, F.lit(180)) - 90).cast("float").alias("latitude"),
        (F.pmod(uid * 13, F.lit(360)) - 180).cast("float").alias("longitude"),
        F.pmod(uid * 37, F.lit(1000)).cast("float").alias("elevation"),
        "tmax",
    )


def access_log_lines(events: DataFrame) -> DataFrame:
    """One web-access log line per event (``value``).

    Host from the user, path from type and id, size from the value. Error
    events are logged with size ``-``, which the log pattern rejects.
    """
    is_error = F.col("event_type") == "error"
    size = F.when(is_error, F.lit("-")).otherwise(
        F.floor(F.col("value") * F.lit(100.0)).cast("long").cast("string")
    )
    return events.select(
        F.format_string(
            '%s - - [%s -0800] "GET %s HTTP/1.0" %d %s',
            F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net")),
            format_log_time("ts"),
            F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")),
            F.when(is_error, F.lit(500)).otherwise(F.lit(200)),
            size,
        ).alias("value")
    )


def order_graph(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Directed edges between customers, one per order (all orders).

    An order of customer c points to customer (orderkey * 7 + 3) mod N, N the
    number of customers (a scalar subquery, computed once on the executors).
    """
    n_customers = customer.select(F.count(F.lit(1))).scalar()
    return orders.select(
        F.col("o_custkey").alias("src"),
        F.pmod(F.col("o_orderkey") * 7 + 3, n_customers).alias("dst"),
    )


def colours(lineitem: DataFrame) -> DataFrame:
    """Colour rows R, G, B (0..255 ints), word: byte-sized keys of each line item."""
    return lineitem.select(
        F.pmod(F.col("l_partkey"), F.lit(256)).cast("int").alias("R"),
        F.pmod(F.col("l_suppkey") * 5, F.lit(256)).cast("int").alias("G"),
        F.pmod(F.col("l_orderkey"), F.lit(256)).cast("int").alias("B"),
        F.col("l_returnflag").alias("word"),
    )


def with_word(rgb: DataFrame) -> DataFrame:
    """Rows with R, G, B and the nearest of the eleven colour words."""
    return rgb.withColumn("word", nearest_word(F.col("R"), F.col("G"), F.col("B")))


def colour_words(lineitem: DataFrame) -> DataFrame:
    """Colour rows R, G, B with the nearest of the eleven colour words."""
    return with_word(colours(lineitem).select("R", "G", "B"))


def colour_counts(lineitem: DataFrame) -> DataFrame:
    """Each colour R, G, B once with the number ``n`` of its rows: never more than 256³ rows."""
    return colours(lineitem).groupBy("R", "G", "B").agg(F.count(F.lit(1)).alias("n"))
