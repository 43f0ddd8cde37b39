"""Observation-table operators (J9-J11): clean readings, daily ranges, widest range per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import join_back_to_max, pair_on


def readings(obs: DataFrame, observation: str, out: str) -> DataFrame:
    """``station, date, <out>`` in degrees for one observation kind, quality-flagged rows dropped."""
    clean = obs.filter(F.col("qflag").isNull() & (F.col("observation") == observation))
    return clean.select("station", "date", (F.col("value") / 10).alias(out))


def daily_ranges(obs: DataFrame) -> DataFrame:
    """``station, date, range``: every TMAX reading paired with every TMIN reading
    of the same station and day (duplicates multiply, as an equi-join does)."""
    paired = pair_on(readings(obs, "TMAX", "tmax"), readings(obs, "TMIN", "tmin"), ["station", "date"])
    return paired.select("station", "date", (F.col("tmax") - F.col("tmin")).alias("range"))


def widest_range_per_date(obs: DataFrame, strategy: str = "auto") -> DataFrame:
    """``date, station, range`` (2-decimal text) of the stations with the largest
    range of each day, ties kept, sorted by date and station."""
    best = join_back_to_max(daily_ranges(obs), "date", "range", strategy=strategy)
    return best.select("date", "station", F.format_number("range", 2).alias("range")).orderBy("date", "station")
