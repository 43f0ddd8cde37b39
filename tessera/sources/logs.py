"""Web-access log lines -> typed rows (SRC7, FN4, FN5).

Parsing is one ``rlike`` and one ``split`` per line on the JVM: no Python per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import parse_log_time, random_row_id, stable_row_id

# --- fixed values ---
# host, time, path and byte count of one request; the byte count must be
# digits, so lines with "-" as size are not well formed and are dropped.
ACCESS_LOG_PATTERN = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'


def parse_access_log(df: DataFrame, column: str = "value", id_mode: str | None = None) -> DataFrame:
    """Keep well-formed lines, return ``host, [id,] datetime, path, bytes``.

    The pattern is evaluated once per line (``rlike``). A line that matches it
    is exactly ten tokens separated by single blanks (host, -, -, [time, zone],
    "method, path, protocol", status, bytes), so one ``split`` then yields every
    field with no further regular-expression work.

    ``id_mode``: None (no id column), ``"random"`` (a UUID per row, as a fresh
    load key) or ``"stable"`` (SHA-256 of the line, repeatable across runs).
    """
    line = F.col(column)
    good = df.filter(line.rlike(ACCESS_LOG_PATTERN))
    tok = F.split(line, " ")
    cols = [F.get(tok, 0).alias("host")]
    if id_mode == "random":
        cols.append(random_row_id().alias("id"))
    elif id_mode == "stable":
        cols.append(stable_row_id(line).alias("id"))
    cols += [
        parse_log_time(F.substr(F.get(tok, 3), F.lit(2))).alias("datetime"),
        F.get(tok, 6).alias("path"),
        F.get(tok, 9).try_cast("long").alias("bytes"),
    ]
    return good.select(*cols)


def unparsed_log_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """The lines that :func:`parse_access_log` leaves out, as ``broken_line``; a NULL line is an empty one."""
    line = F.coalesce(F.col(column), F.lit(""))
    return df.filter(~line.rlike(ACCESS_LOG_PATTERN)).select(line.alias("broken_line"))


def host_visits(logs: DataFrame) -> DataFrame:
    """Per host: number of requests and bytes served (the correlation input)."""
    return logs.groupBy("host").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("bytes").alias("bytes")
    )
