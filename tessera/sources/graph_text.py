"""Adjacency-list text ``node: n1 n2 ...`` -> edge rows (SRC8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_adjacency(df: DataFrame, column: str = "value") -> DataFrame:
    """``src long, dst long`` per listed neighbour; a node without neighbours adds no edge."""
    parts = F.split(F.col(column), ":", 2)
    src = F.trim(F.get(parts, 0))
    targets = F.split(F.trim(F.coalesce(F.get(parts, 1), F.lit(""))), r"\s+")
    return (
        df.select(src.alias("src"), F.explode(targets).alias("dst"))
        .filter(F.col("dst") != "")
        .select(F.col("src").try_cast("long").alias("src"), F.col("dst").try_cast("long").alias("dst"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    )
