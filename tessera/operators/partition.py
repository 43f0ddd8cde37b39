"""Partition control (PRT1-PRT4)."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, n: int | None = None, *keys: str) -> DataFrame:
    """Even out partitions.

    With ``n``: a round-robin (or by-key) shuffle into ``n`` partitions, the
    fix for unsplittable or uneven input files. Without: a REBALANCE hint, so
    AQE picks the count from measured sizes and splits skewed partitions.
    """
    if n is None:
        return df.hint("rebalance", *keys) if keys else df.hint("rebalance")
    return df.repartition(n, *keys) if keys else df.repartition(n)


def spread_if_uneven(df: DataFrame, min_share: float = 0.5, partitions: int | None = None,
                     splits_hold_rows: bool = False) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the input is badly split.

    An input of at least as many files as cores is left alone at once (the
    file listing is already on the driver, no job runs). For fewer files the
    scan partitions that actually hold rows are counted; if fewer than
    ``min_share`` of the default parallelism are used, as with unsplittable
    compressed files or a few huge row groups, the rows are spread before the
    per-row work. Input that is already split over the cluster is returned
    unchanged, so no data is shuffled for nothing.

    How the used partitions are counted: for Parquet a zero-column scan (the
    reader answers from its footers). Line-based input (text, CSV, JSON
    lines) passes ``splits_hold_rows=True``: every planned split holds lines
    (a gzip file is one split), so the planned count is used and no job runs,
    which spares decompressing the input once just to count.
    """
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    if splits_hold_rows:
        used = df.rdd.getNumPartitions()  # planned scan splits; no job
    else:
        used = df.select(F.spark_partition_id().alias("__p")).distinct().count()
    return df.repartition(target) if used < target * min_share else df


def single_file(df: DataFrame) -> DataFrame:
    """One output partition. For small final results only."""
    return df.coalesce(1)


@contextmanager
def cached(df: DataFrame):
    """Keep ``df`` in memory while it feeds more than one consumer."""
    kept = df.cache()
    try:
        yield kept
    finally:
        kept.unpersist()


def split_mark(keys: str | Sequence[str], seed: int = 0) -> Column:
    """Eight hex digits drawn from ``keys``: the head of an MD5, so other engines draw the same."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 8)


def _edges(weights: Sequence[float]) -> list[str]:
    """The marks at which the second and later parts of ``weights`` begin."""
    total = float(sum(weights))
    return [f"{int(sum(weights[:i]) / total * 2**32):08x}" for i in range(1, len(weights))]


def digest_split(df: DataFrame, keys: str | Sequence[str], weights: Sequence[float] = (0.75, 0.25), seed: int = 0) -> list[DataFrame]:
    """Split rows by :func:`split_mark` of ``keys`` into parts of roughly ``weights``.

    Like :func:`hash_split`, and reproducible outside Spark: a part is a range
    of hex digits (``< 'c0000000'`` is the first three quarters).
    """
    mark, edges = split_mark(keys, seed), [None, *_edges(weights), None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else mark >= low
        parts.append(df.filter(inside if high is None else inside & (mark < high)))
    return parts


def digest_part(names: Sequence[str], keys: str | Sequence[str], weights: Sequence[float] = (0.75, 0.25), seed: int = 0) -> Column:
    """The name of the part that :func:`digest_split` puts a row in, from one digest: the rows are read once for all parts."""
    mark = split_mark(keys, seed)
    number = sum((F.when(mark >= edge, 1).otherwise(0) for edge in _edges(weights)), F.lit(0))
    return F.get(F.array(*[F.lit(name) for name in names]), number)


def hash_split(df: DataFrame, keys: str | Sequence[str], weights: Sequence[float] = (0.75, 0.25),
               seed: int = 0) -> list[DataFrame]:
    """Split rows by a hash of ``keys`` into parts of roughly ``weights``.

    Unlike ``randomSplit`` the assignment depends only on the key values, so
    it is the same for any partitioning, task retry or re-run.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    total = float(sum(weights))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(10_000)) / F.lit(10_000.0)
    out, low = [], 0.0
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        out.append(df.filter((bucket >= F.lit(low)) & (bucket < F.lit(high)) if i < len(weights) - 1 else bucket >= F.lit(low)))
        low = high
    return out
