"""Keyed tables: upsert, denormalisation, order lines (SNK8, J16-J18, FLT9)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import order_line


def filter_keys(df: DataFrame, column: str, keys: Iterable | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ``keys``.

    A Python list becomes ``isin`` with every key cast to the column's type
    (so the predicate still reaches the Parquet scan); a DataFrame of keys
    becomes a left-semi join, which scales to any number of keys.
    """
    if isinstance(keys, DataFrame):
        other = keys.select(F.col(keys.columns[0]).alias("__key")).distinct()
        return df.join(other, df[column] == other["__key"], "left_semi")
    kind = df.schema[column].dataType
    return df.filter(F.col(column).isin([F.lit(k).cast(kind) for k in keys]))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the largest ``order`` (then the largest row content).

    ``max(struct)`` is a partial aggregate: a key written many times is folded
    on the map side, so a hot key never brings all its rows to one task.
    """
    cols = df.columns
    payload = [c for c in cols if c not in keys]
    fields = ([order] if order else []) + [c for c in payload if c != order]
    best = F.max(F.struct(*[F.col(c).alias(c) for c in fields])).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in cols])


def upsert_by_key(base: DataFrame, updates: DataFrame, keys: str | Sequence[str],
                  seq: str | None = None) -> DataFrame:
    """Write ``updates`` into the keyed table ``base`` (one row per key): the last write wins.

    Without ``seq`` the updates are newer than every base row, and a key may
    occur in them once only: which of two writes was the last can't be told, so
    the job fails on a repeated key. Base rows whose key is updated are dropped
    by a left-anti join on the update keys and the updates are appended; when
    the update keys are small AQE broadcasts them, so the base is not shuffled.

    With ``seq`` (versions may arrive out of order, keys may repeat) the
    updates alone are reduced to the largest ``seq`` per key, and one outer
    join on the key keeps the later of the two versions. Equal ``seq`` are
    decided by the row content, so the result never depends on partitioning.
    The base is never aggregated. NULL keys meet no other key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = base.columns
    updates = updates.select(*cols)
    if seq is None:
        newest = _one_per_key(updates, keys)
        kept = base.join(newest.select(*keys), keys, "left_anti")
        return kept.unionByName(newest).select(*cols)
    version = F.struct(seq, *[c for c in cols if c not in keys and c != seq])
    old = base.select(*keys, version.alias("__old"))
    new = latest_per_key(updates, keys, seq).select(*keys, version.alias("__new"))
    later = F.greatest("__old", "__new").alias("__row")  # of a missing and a present version, the present one
    both = old.join(new, keys, "full_outer").select(*keys, later)
    return both.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols])


def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, or a failing job if a key occurs more than once."""
    payload = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.first(F.struct(*payload)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    error = F.raise_error(F.lit("repeated key in an update batch: pass the column that orders its versions as seq"))
    checked = counted.select(*keys, F.when(F.col("__n") == 1, F.col("__row")).otherwise(error).alias("__row"))
    return checked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def part_names_by_order(lineitem: DataFrame, part: DataFrame, orderkey: str = "l_orderkey",
                        partkey: str = "l_partkey", p_partkey: str = "p_partkey",
                        p_name: str = "p_name", out: str = "part_names") -> DataFrame:
    """Per order key: the sorted set of names of its parts.

    lineitem ⋈ part, then a partial ``collect_set`` per order, so the order
    side is joined one row per order afterwards (pre-aggregation before the
    second join shrinks its input to one row per order).
    """
    lines = lineitem.select(F.col(orderkey).alias("__ok"), F.col(partkey).alias("__pk"))
    parts = part.select(F.col(p_partkey).alias("__pk"), F.col(p_name).alias("__name"))
    named = lines.join(parts, "__pk", "inner")
    return named.groupBy("__ok").agg(F.sort_array(F.collect_set("__name")).alias(out))


def denormalize_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                       o_orderkey: str = "o_orderkey", out: str = "part_names") -> DataFrame:
    """Orders with the set of their part names (orders without lines are dropped)."""
    names = part_names_by_order(lineitem, part, out=out)
    return orders.join(names, orders[o_orderkey] == names["__ok"], "inner").drop("__ok")


def order_lines(orders: DataFrame, lineitem: DataFrame, part: DataFrame, keys=None,
                o_orderkey: str = "o_orderkey", o_totalprice: str = "o_totalprice") -> DataFrame:
    """``o_orderkey, line`` with ``Order #k $price: names`` computed by joining at query time."""
    if keys is not None:
        orders = filter_keys(orders, o_orderkey, keys)
        lineitem = filter_keys(lineitem, "l_orderkey", keys)
    slim = orders.select(o_orderkey, o_totalprice)
    denorm = denormalize_orders(slim, lineitem, part)
    return lines_from_denormalized(denorm, None, o_orderkey, o_totalprice)


def write_keyed_table(df: DataFrame, path: str, key: str | Sequence[str], fmt: str = "parquet",
                      partitions: int | None = None) -> None:
    """Replace the table at ``path`` with ``df`` clustered and sorted by ``key``.

    Range partitioning gives each output file a narrow, disjoint key range and
    the sort orders the row groups inside it, so a later key lookup pushed to
    the scan (``key IN (...)``) skips the files and row groups whose min/max
    statistics exclude it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").format(fmt).save(path)


def write_bucketed(df: DataFrame, name: str, key: str | Sequence[str], buckets: int, path: str,
                   sort: bool = True) -> DataFrame:
    """Store ``df`` as the catalog table ``name`` hashed into ``buckets`` by ``key``
    (files at ``path``) and return the table.

    Tables bucketed the same way on their join key are co-located: joining
    them needs no exchange on either side, and aggregating by the key needs
    none either. This is the Spark form of tables partitioned by their key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def lines_from_denormalized(denorm: DataFrame, keys=None, o_orderkey: str = "o_orderkey",
                            o_totalprice: str = "o_totalprice", names: str = "part_names") -> DataFrame:
    """``o_orderkey, line`` read straight from a denormalised orders table (no join)."""
    if keys is not None:
        denorm = filter_keys(denorm, o_orderkey, keys)
    return denorm.select(
        F.col(o_orderkey), order_line(o_orderkey, o_totalprice, names).alias("line")
    )
