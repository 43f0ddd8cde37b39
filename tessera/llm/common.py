"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, scratch_root

#: A word: a run of characters other than space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder of ``spark.checkpoint.dir``, lineage cut."""
    scratch_root(df.sparkSession)  # sets the context's folder from the session's setting
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and reread: for the state of loops.

    A checkpointed frame keeps the size estimate of the plan it came from. In a
    loop that joins its state with itself the estimate is squared every round,
    until planning takes longer than the work; a reread table has its real size.
    """
    path = scratch_path(df.sparkSession, "stored", unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def words_of(text: str | Column) -> Column:
    """The words of a text as an array; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACE, -1), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
