"""Connected components of a link table, by alternating large and small stars.

Each round hangs every node's larger neighbours on the smallest node around it
(large star), then every node and its smaller neighbours on the smallest of
them (small star), until nothing changes: a node then has one link, to the
smallest node of its component (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014). Minima are pre-aggregated in the tasks and the
joins that follow are ones whose hot keys Spark may split, so a node that a
third of all links touch doesn't become one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    up = both.filter(F.col("v") > F.col("u"))
    return up.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
    return hung.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node of its component.

    Links of a node to itself and repeated links are allowed; nulls are not
    links. An empty table gives an empty table. Each round's links are
    a written table; the driver sees one count and hash sum per round.
    """
    a, b = links.columns
    x, y = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    now = stored(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                       .select(x.alias("a"), y.alias("b")).distinct())
    known = _signature(now)
    while known[0]:
        now = stored(_small_star(_large_star(now)))
        found = _signature(now)
        if found == known:
            break
        known = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
