"""File and table sources (SRC1-SRC6, SRC9, SRC11, SRC12).

Schemas are always declared; nothing is inferred. Filters and column
selections applied later are pushed into these scans by Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import hour_key_from_path


def read_lines(spark: SparkSession, path: str | list[str], rebalance: int | None = None) -> DataFrame:
    """Text lines as ``value string`` (plain or compressed, file or folder).

    Compressed files such as gzip cannot be split, so each lands in one task;
    ``rebalance`` spreads the lines over that many partitions before the heavy
    work (a round-robin shuffle that evens out skewed file sizes).
    """
    df = spark.read.text(path)
    return df.repartition(rebalance) if rebalance else df


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines under a declared schema. Broken lines become all-NULL rows."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


#: Where a line that can't be read is kept.
BROKEN = "broken_line"


def parse_json(df: DataFrame, column: str, schema: T.StructType, keep_broken: bool = False) -> DataFrame:
    """Parse a text column holding one JSON document per row into typed columns.

    A broken document gives all-NULL columns; with ``keep_broken`` its text is
    in the column ``broken_line``, NULL for the others. Broken is what isn't
    JSON, a value that doesn't fit its column, and a NULL or blank line.
    """
    if not keep_broken:
        return df.select(F.from_json(F.col(column), schema).alias("__j")).select("__j.*")
    wide = T.StructType([*schema, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json(F.col(column), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    rows = df.select(F.col(column).alias("__line"), parsed.alias("__j"))
    broken = F.when(F.trim(F.coalesce("__line", F.lit(""))) == "", F.coalesce("__line", F.lit(""))).otherwise(F.col(f"__j.{BROKEN}"))
    # a document with a value that doesn't fit counts as broken as a whole
    fields = [F.when(broken.isNull(), F.col(f"__j.{f.name}")).alias(f.name) for f in schema]
    return rows.select(*fields, broken.alias(BROKEN))


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",", header: bool = False
) -> DataFrame:
    """Headerless (by default) CSV under a declared schema."""
    return spark.read.schema(schema).csv(path, sep=sep, header=header, mode="PERMISSIVE")


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = " ") -> DataFrame:
    """Delimited text without quoting: a field starting with ``"`` stays literal."""
    return spark.read.schema(schema).csv(path, sep=sep, quote="", escape="", header=False)


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the path of the file each row came from (file sources only)."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def with_hour_from_file(df: DataFrame, column: str = "hour") -> DataFrame:
    """Add the ``YYYYMMDD-HH`` key taken from the base name of the source file."""
    return df.withColumn(column, hour_key_from_path(F.col("_metadata.file_name")))


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet", **options) -> DataFrame:
    """A keyed table. Parquet path by default; any ``format`` with its options
    (a connector's keyspace/table options pass straight through)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path_or_name) if path_or_name else reader.load()


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rows(spark: SparkSession, data: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small DataFrame from driver-side values under a declared schema."""
    return spark.createDataFrame(list(data), schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to SQL as a temporary view; returns ``df`` for chaining."""
    df.createOrReplaceTempView(name)
    return df
