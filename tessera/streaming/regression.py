"""Running least-squares line over a stream (STR1-STR3, SNK9).

The state is one row of sums (n, Σx, Σy, Σx², Σxy) kept by Spark's state
store; slope and intercept are derived from it in every micro-batch. The
checkpoint lives in the shared scratch folder, so a restarted query resumes
from its last committed batch instead of starting over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import split_get
from tessera.session import scratch_path
from tessera.sinks.keyed_store import KeyedStore


def parse_points(messages: DataFrame, column: str = "value") -> DataFrame:
    """``"x y"`` text -> ``x, y`` doubles; unreadable numbers become NULL."""
    text = F.col(column).cast("string")
    return messages.select(
        split_get(text, " ", 0).try_cast("double").alias("x"),
        split_get(text, " ", 1).try_cast("double").alias("y"),
    )


def running_fit(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Global streaming aggregate: n and sums over complete pairs, then slope/intercept."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xv, yv = F.when(both, F.col(x)), F.when(both, F.col(y))
    sums = points.agg(
        F.count(xv).alias("n"),
        F.sum(xv).alias("sx"),
        F.sum(yv).alias("sy"),
        F.sum(xv * xv).alias("sxx"),
        F.sum(xv * yv).alias("sxy"),
        # central moments: no cancellation on large values, NULL without variance
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )
    return sums


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """A file source as a stream (new files in ``path`` are new data)."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A Kafka topic as ``value string`` messages (needs the Kafka connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"))


def start_stream(df: DataFrame, mode: str = "update", sink: str = "console", checkpoint: str | None = None,
                 available_now: bool = False, processing_time: str | None = None, **options):
    """Start a streaming write; returns the StreamingQuery."""
    spark = df.sparkSession
    writer = df.writeStream.outputMode(mode).format(sink).options(**options)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "streams", unique=True))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_table(df: DataFrame, path: str, mode: str = "update", checkpoint: str | None = None,
                 timeout_s: float | None = None) -> DataFrame:
    """Run a stream over everything available now; each batch's rows go to the
    Parquet folder ``<path>/batch_id=<id>``. Returns the rows of the last batch.

    A batch replayed after a failure overwrites its own folder, so the sink is
    idempotent and the result exactly-once.
    """
    spark = df.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode(mode).foreachBatch(write_batch).trigger(availableNow=True)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "streams", unique=True))
    query = writer.start()
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout_s} s")
    out = spark.read.parquet(path)
    last = out.agg(F.max("batch_id")).first()[0]
    return out.filter(F.col("batch_id") == F.lit(last)).drop("batch_id")


def run_to_store(df: DataFrame, store: KeyedStore, checkpoint: str, timeout_s: float | None = None) -> DataFrame:
    """Run an update-mode stream over everything available now into a keyed store; returns the store's table.

    ``df`` is a streaming aggregate whose rows are the groups that a batch
    changed, one per ``store`` key. Each batch is merged by key with its
    number as the version (column ``batch_id``), so groups that it doesn't
    change stay, and a batch that is replayed after a failure writes the rows
    that it wrote before. Started again with the same ``checkpoint``, the
    stream goes on after its last committed batch with its state.
    """
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        store.merge(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), seq="batch_id")

    query = df.writeStream.outputMode("update").foreachBatch(merge_batch).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout_s} s")
    return store.read()


def running_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Streaming aggregate: rows and sum of ``value`` per ``key``; a null value counts as a row without one."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def run_linear_fit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items arrive as files; the running fit of price on quantity is kept up to date."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema
    source = file_stream(spark, f"{sf_dir.rstrip('/')}/lineitem*.parquet", schema)
    points = source.select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    fit = running_fit(points)
    final = run_to_table(fit, scratch_path(spark, "streams", "linear_fit", unique=True))
    return final.select(
        F.col("n").cast("long").alias("n"),
        F.round("slope", 6).alias("slope"),
        F.round("intercept", 6).alias("intercept"),
    )
