"""Group and global aggregates (AGG1-AGG5, AGG7-AGG14).

Every aggregate here is algebraic or has a partial form, so Spark plans
HashAggregate(partial) -> Exchange -> HashAggregate(final): a hot key is
folded on the map side first and never brings all its rows to one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import (
    intercept_from_sums,
    moment_sums,
    pearson as pearson_of,
    slope_from_sums,
)
from tessera.functions.text import tokens


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def words(df: DataFrame, column: str = "value", unicode_blanks: bool = False, out: str = "word") -> DataFrame:
    """One row per lower-cased, non-empty token of ``column`` (whole texts).

    ``explode(split)`` then ``lower`` and the empty-token filter as plain
    expressions: all inside whole-stage codegen (higher-order array functions
    would be interpreted).
    """
    toks = df.select(F.explode(tokens(column, unicode_blanks)).alias("__tok"))
    return toks.select(F.lower("__tok").alias(out)).filter(F.col(out) != "")


def word_count(df: DataFrame, column: str = "value", unicode_blanks: bool = False) -> DataFrame:
    """``word, n``: occurrences of every word (map-side combined count)."""
    return words(df, column, unicode_blanks).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, keys: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per key (map-side combined count)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(out))


def group_mean(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """``keys, n, total, mean``; NULL values are ignored (not counted)."""
    v = F.col(value).cast("double")
    return df.groupBy(*_keys(keys)).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean")
    )


def group_max(df: DataFrame, keys: str | Sequence[str], value: str, out: str = "max_value",
              floor: float | int | None = None) -> DataFrame:
    """Maximum per key; with ``floor`` the result never drops below it."""
    m = F.max(value)
    if floor is not None:
        m = F.greatest(F.lit(floor), m)
    return df.groupBy(*_keys(keys)).agg(m.alias(out))


def argmax_one(df: DataFrame, keys: str | Sequence[str], value: str, tie: str | Sequence[str]) -> DataFrame:
    """One row per key: the largest ``value``; ties go to the largest ``tie`` columns.

    ``max(struct(value, tie...))`` orders structs field by field, which is the
    same rule as comparing ``(value, tie)`` tuples, and aggregates partially.
    """
    tie = _keys(tie)
    best = F.max(F.struct(F.col(value).alias("v"), *[F.col(t).alias(t) for t in tie])).alias("__best")
    return df.groupBy(*_keys(keys)).agg(best).select(
        *_keys(keys), F.col("__best.v").alias(value), *[F.col(f"__best.{t}").alias(t) for t in tie]
    )


def min_struct_by(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per key with the smallest ``order`` tuple (then ``carry`` columns)."""
    fields = [*order, *carry]
    best = F.min(F.struct(*[F.col(c).alias(c) for c in fields])).alias("__best")
    return df.groupBy(*_keys(keys)).agg(best).select(
        *_keys(keys), *[F.col(f"__best.{c}").alias(c) for c in fields]
    )


def group_sums(df: DataFrame, keys: str | Sequence[str], sums: Mapping[str, str | Column]) -> DataFrame:
    """Several sums per key, e.g. ``{"visits": F.lit(1), "bytes": "bytes"}``."""
    aggs = [F.sum(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in sums.items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def distinct_set(df: DataFrame, keys: str | Sequence[str], value: str, out: str = "values") -> DataFrame:
    """Sorted array of the distinct values per key (a set column, deterministic order)."""
    return df.groupBy(*_keys(keys)).agg(F.sort_array(F.collect_set(value)).alias(out))


def moments(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    """One row: n, Σx, Σy, Σx², Σy², Σxy over complete (x, y) pairs."""
    return df.agg(*moment_sums(x, y))


def pearson(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    """One row: the sums, r and r². r is NULL when either variance is zero."""
    sums = df.agg(*moment_sums(x, y), pearson_of(x, y).alias("r"))
    return sums.withColumn("r2", F.col("r") * F.col("r"))


def linear_fit(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    """One row: n, slope and intercept of the least-squares line y = α + βx."""
    xd = (F.col(x) if isinstance(x, str) else x).cast("double")
    yd = (F.col(y) if isinstance(y, str) else y).cast("double")
    return df.agg(
        F.regr_count(yd, xd).alias("n"),
        F.regr_slope(yd, xd).alias("slope"),
        F.regr_intercept(yd, xd).alias("intercept"),
    )


def linear_fit_from_moments(sums: DataFrame) -> DataFrame:
    """Slope and intercept from a moments row (the streaming form)."""
    beta = slope_from_sums()
    return sums.withColumn("slope", beta).withColumn("intercept", intercept_from_sums(F.col("slope")))


def total(df: DataFrame, value: str | Column, out: str = "total") -> DataFrame:
    """Whole-dataset sum in one row."""
    return df.agg(F.sum(F.col(value) if isinstance(value, str) else value).alias(out))
