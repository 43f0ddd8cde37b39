"""Sinks (SNK1-SNK7, SNK11, SNK12).

Writers are distributed: one file per partition. ``single_file=True`` funnels
the output through one task and is meant for small final results only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import json_array_line, key_value_line


def _maybe_single(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_lines(df: DataFrame, path: str, line: Column | str | None = None, mode: str = "overwrite",
                single_file: bool = False, compression: str | None = None) -> None:
    """One text line per row; ``line`` defaults to the only column."""
    out = df.select((F.col(line) if isinstance(line, str) else line).alias("value")) if line is not None else df
    writer = _maybe_single(out, single_file).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def format_kv(df: DataFrame, key: str, value: str, sep: str = "\t") -> DataFrame:
    """``key<sep>value`` lines (the key/value text output format)."""
    return df.select(key_value_line(key, value, sep).alias("value"))


def to_json_lines(df: DataFrame, as_array: bool = False) -> DataFrame:
    """One JSON text per row: an object, or a positional array of the columns
    (``["pose", 4.0]``: string columns quoted, numbers as numbers)."""
    if as_array:
        strings = tuple(i for i, f in enumerate(df.schema.fields) if not isinstance(f.dataType, T.NumericType))
        return df.select(json_array_line(*df.columns, strings=strings).alias("value"))
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None,
               single_file: bool = False) -> None:
    """JSON lines; NULL fields are left out of each object."""
    writer = _maybe_single(df, single_file).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", header: bool = False,
              single_file: bool = False) -> None:
    """Headerless CSV by default."""
    _maybe_single(df, single_file).write.mode(mode).csv(path, sep=sep, header=header)


def split_by(df: DataFrame, path: str, predicates: Mapping[str, Column], fmt: str = "json",
             mode: str = "overwrite", label_col: str = "part") -> None:
    """Write each row to the sub-folder of the first predicate it meets, in one pass.

    One scan of the input and one write job: rows get a label column and the
    writer partitions by it (``<path>/<label_col>=<name>/``). Rows that meet no
    predicate are dropped. Nothing is cached, so nothing has to fit in memory.
    """
    label = None
    for name, pred in predicates.items():
        label = F.when(pred, F.lit(name)) if label is None else label.when(pred, F.lit(name))
    labelled = df.withColumn(label_col, label).filter(F.col(label_col).isNotNull())
    labelled.write.mode(mode).partitionBy(label_col).format(fmt).save(path)


def split_by_scans(df: DataFrame, path: str, predicates: Mapping[str, Column], fmt: str = "json",
                   mode: str = "overwrite", cache: bool = True) -> None:
    """Same output layout as :func:`split_by`, one filtered write per predicate.

    With ``cache`` the shared input is kept in memory between the writes; the
    single-pass :func:`split_by` needs neither the cache nor the second scan.
    """
    src = df.cache() if cache else df
    try:
        claimed = None
        for name, pred in predicates.items():
            take = pred if claimed is None else (pred & ~claimed)
            src.filter(take).write.mode(mode).format(fmt).save(f"{path}/part={name}")
            claimed = pred if claimed is None else (claimed | pred)
    finally:
        if cache:
            src.unpersist()


def replace_table(df: DataFrame, path_or_name: str, fmt: str = "parquet", **options) -> None:
    """Load a keyed table by replacing its contents (overwrite, not truncate + append)."""
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if fmt == "parquet" or "/" in path_or_name:
        writer.save(path_or_name)
    else:
        writer.saveAsTable(path_or_name)


def snapshot(df: DataFrame, path: str, iteration: int, fmt: str = "parquet") -> DataFrame:
    """Persist an iteration's state to ``<path>/iter-<i>`` and continue from the files.

    Reading the written files back cuts the lineage (like a checkpoint) and
    survives the loss of any executor.
    """
    target = f"{path.rstrip('/')}/iter-{iteration}"
    df.write.mode("overwrite").format(fmt).save(target)
    return df.sparkSession.read.format(fmt).load(target)


def snapshot_counted(df: DataFrame, path: str, iteration: int, fmt: str = "parquet") -> tuple[DataFrame, int]:
    """:func:`snapshot` that also returns the number of rows written (an
    observed metric of the write, no extra job)."""
    target = f"{path.rstrip('/')}/iter-{iteration}"
    return _write_counted(df, target, fmt, f"rows_iter_{iteration}")


def _write_counted(df: DataFrame, path: str, fmt: str, name: str) -> tuple[DataFrame, int]:
    from pyspark.sql import Observation

    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path), int(seen.get["rows"])


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Computes ``df`` once, cuts its lineage and survives executor loss (the files
    live in shared storage, not in executor memory).
    """
    from tessera.session import scratch_path

    path = scratch_path(df.sparkSession, "stages", label, unique=True)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_counted(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """:func:`materialize` that also returns the number of rows written.

    The count is an observed metric of the write itself
    (``DataFrame.observe``), so it costs no extra job.
    """
    from tessera.session import scratch_path

    path = scratch_path(df.sparkSession, "stages", label, unique=True)
    return _write_counted(df, path, "parquet", f"rows_{label}")


def collect_scalar(df: DataFrame, column: str | None = None):
    """First value of a one-row result (e.g. a global aggregate) on the driver."""
    row = df.first()
    if row is None:
        return None
    return row[column] if column else row[0]
