"""Order audit: whether written files are sorted as promised (SRT1-SRT3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_audit(written: DataFrame, key: Column) -> DataFrame:
    """One row: ``n`` rows and ``inversions``, places where ``key`` falls below the row before.

    ``written`` is read from files. Rows are compared with their neighbour in
    the file, and each piece's last key with the first of the next one, pieces
    in the order of file names and of places in a file. A piece is what one
    task reads of a file, so no task gets a file however large it is; what is
    compared across pieces is a row per piece. Nulls sort first. For a
    descending order pass a negated key.
    """
    rows = written.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("at"), F.struct(key.isNotNull().alias("known"), key.alias("key")).alias("key"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    compared = rows.withColumn("before", F.lag("key").over(inside))
    pieces = compared.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("key")).alias("inside"),
        F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    joined = pieces.withColumn("before", F.lag("last").over(Window.orderBy("file", "block")))
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      F.coalesce(F.sum(F.col("inside") + F.when(F.col("before") > F.col("first"), 1).otherwise(0)), F.lit(0)).alias("inversions"))
