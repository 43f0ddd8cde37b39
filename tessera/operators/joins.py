"""Joins (JOIN1-JOIN7, AGG6).

By default (``"auto"``) the planner and AQE choose: AQE broadcasts a side whose
shuffled size, measured while the query runs, is below Spark's own threshold,
and splits skewed partitions. The explicit broadcast form writes the small
side once and broadcasts it only if its rows' real bytes fit a bound; past the
bound the written table joins like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.aggregate import group_max, group_mean
from tessera.sinks.files import materialize

#: Largest side, in bytes of its rows as text, that the explicit form broadcasts.
BROADCAST_BYTES = 64 * 1024 * 1024


def sized_broadcast(small: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``small`` written to the shared scratch folder, and whether it is marked for broadcast.

    The rows' bytes (their length as JSON, names included, so rather too many
    than too few) are summed by the write itself; the driver sees one number.
    """
    seen = Observation("broadcast_side")
    length = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in small.columns])))
    staged = materialize(small.observe(seen, F.sum(length + F.lit(16)).alias("bytes")), "broadcast")
    fits = (seen.get["bytes"] or 0) <= max_bytes
    return (F.broadcast(staged) if fits else staged), fits


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", strategy: str = "auto",
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a big frame with a (probably) small one.

    ``strategy``: ``"auto"`` leaves it to the planner and AQE and runs nothing
    now; ``"broadcast"`` writes ``small`` and broadcasts it if it fits;
    ``"shuffle"`` forces a sort-merge join (both sides exchanged on the key).
    """
    if strategy == "broadcast":
        small, _ = sized_broadcast(small, max_bytes)
    elif strategy == "shuffle":
        small = small.hint("merge")
    return big.join(small, on, how)


def relative_to_group_mean(df: DataFrame, key: str, value: str, out: str = "relative",
                           strategy: str = "auto", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Each row's ``value`` divided by its group's mean; groups with mean <= 0 dropped.

    The means are one row per group (partial aggregate, skew-safe); the detail
    rows are never shuffled when the means go out by broadcast.
    """
    means = group_mean(df, key, value).filter(F.col("mean") > 0).select(key, "mean")
    joined = join_small(df, means, key, "inner", strategy, max_bytes)
    return joined.withColumn(out, F.col(value).cast("double") / F.col("mean")).drop("mean")


def join_back_to_max(df: DataFrame, keys: str | Sequence[str], value: str, strategy: str = "auto",
                     max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All rows whose ``value`` equals the maximum of their group (ties kept).

    Max per group (partial aggregate) joined back on (keys, value). Unlike a
    ``rank()`` window this never sorts a whole group inside one task, so a hot
    group costs no more than any other. Where ``df`` is itself an aggregate,
    ``"auto"`` computes it once and reuses its exchange for both sides.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    best = group_max(df, keys, value, out="__max").withColumnRenamed("__max", value)
    return join_small(df, best, [*keys, value], "inner", strategy, max_bytes)


def pair_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on several columns; duplicate keys multiply as usual."""
    return left.join(right, list(keys), "inner")


def with_previous_day(df: DataFrame, key: str, date: str, value: str, out: str | None = None) -> DataFrame:
    """Rows joined with the same key's row of the day before (a gap gives no row).

    An equi-join on (key, date - 1), not ``lag``: a missing day must drop the
    pair instead of pairing with an older day. NULL keys and dates are dropped
    once, before the two sides part, and the shift is in the condition, so
    both sides share one scan and its exchange.
    """
    out = out or f"yesterday_{value}"
    days = df.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    prev = days.select(F.col(key).alias("__k"), F.col(date).alias("__d"), F.col(value).alias(out))
    cond = [days[key] == prev["__k"], F.date_sub(days[date], 1) == prev["__d"]]
    return days.join(prev, cond, "inner").drop("__k", "__d")
