"""Text column functions: tokenising, splitting, keys from paths, log times, line formats.

All of them return Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
# A word separator is any run of ASCII punctuation or blank characters
# (the POSIX \p{Punct} class of Java regular expressions, plus \s).
WORD_SEPARATOR = r"[\p{Punct}\s]+"
# Same with Unicode blanks (no-break space and friends) treated as separators.
WORD_SEPARATOR_UNICODE = r"(?U)[\p{Punct}\s]+"
# Time stamp of an access log line, the zone offset is carried separately.
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
# Hour key inside a page-count file base name: 1-based characters 12..22,
# e.g. "pagecounts-20160801-020000" -> "20160801-02".
HOUR_KEY_START, HOUR_KEY_LENGTH = 12, 11


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column, unicode_blanks: bool = False) -> Column:
    """Array of tokens of ``text`` split on punctuation/blank runs (may hold '')."""
    sep = WORD_SEPARATOR_UNICODE if unicode_blanks else WORD_SEPARATOR
    return F.split(_col(text), sep)


def split_get(text: str | Column, sep: str, index: int) -> Column:
    """Item ``index`` (0-based) of ``text`` split on regex ``sep``; NULL when absent.

    ``get`` (not ``getItem``) so an out-of-range index is NULL under ANSI mode.
    """
    return F.get(F.split(_col(text), sep), index)


def base_name(path: str | Column) -> Column:
    """Last path segment of a file path or URL (everything after the last ``/``)."""
    return F.substring_index(_col(path), "/", -1)


def hour_key_from_path(path: str | Column) -> Column:
    """``YYYYMMDD-HH`` hour key from a page-count file path (no Python UDF)."""
    return F.substring(base_name(path), HOUR_KEY_START, HOUR_KEY_LENGTH)


def parse_log_time(text: str | Column) -> Column:
    """``dd/Mon/yyyy:HH:MM:SS`` to a timestamp without zone; NULL if malformed.

    Parsed straight to ``timestamp_ntz``, so the result does not depend on the
    session time zone (going through a zoned timestamp would move a time in a
    daylight-saving gap by an hour). ``to_timestamp_ntz`` fails on malformed
    text, so it only runs where ``try_to_timestamp`` accepts the text.
    """
    t, fmt = _col(text), F.lit(LOG_TIME_FORMAT)
    return F.when(F.try_to_timestamp(t, fmt).isNotNull(), F.to_timestamp_ntz(t, fmt))


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def day_key(ts: str | Column, pattern: str = "yyyyMMdd") -> Column:
    """The date of a timestamp without zone as text (``pattern`` of date fields only)."""
    return F.date_format(F.to_date(_col(ts)), pattern)


def hour_key(ts: str | Column) -> Column:
    """``YYYYMMDD-HH`` of a timestamp without zone, independent of the session
    time zone (built from the date and the hour field, never through a zoned
    timestamp)."""
    return F.concat(day_key(ts), F.lit("-"), _two_digits(F.hour(_col(ts))))


def format_log_time(ts: str | Column) -> Column:
    """A timestamp without zone as ``dd/Mon/yyyy:HH:MM:SS`` log text (independent
    of the session time zone, like :func:`hour_key`)."""
    t = _col(ts)
    return F.concat_ws(":", day_key(t, "dd/MMM/yyyy"), _two_digits(F.hour(t)), _two_digits(F.minute(t)),
                       _two_digits(F.second(t)))


def random_row_id() -> Column:
    """A random UUID per row (like a fresh key for every load)."""
    return F.uuid()


def stable_row_id(*cols: str | Column) -> Column:
    """Repeatable id: SHA-256 of the columns joined by a unit separator; a NULL is a NUL character."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)


def key_value_line(key: str | Column, value: str | Column, sep: str = "\t") -> Column:
    """``key<sep>value`` text line (the key/value text output format); NULL is empty text."""
    return F.concat(F.coalesce(_col(key).cast("string"), F.lit("")), F.lit(sep),
                    F.coalesce(_col(value).cast("string"), F.lit("")))


def word_count_line(word: str | Column, n: str | Column) -> Column:
    """``word n`` line of the word-count output."""
    return F.format_string("%s %d", _col(word), _col(n))


def sorted_join(values: str | Column, sep: str = ", ") -> Column:
    """Sort an array of strings and join it into one text."""
    return F.array_join(F.sort_array(_col(values)), sep)


def order_line(orderkey: str | Column, totalprice: str | Column, names: str | Column) -> Column:
    """``Order #<key> $<price with 2 decimals>: <sorted names, comma separated>``."""
    return F.format_string(
        "Order #%d $%.2f: %s",
        _col(orderkey),
        _col(totalprice).cast("double"),
        sorted_join(names),
    )


def json_string(c: str | Column) -> Column:
    """A string column as a JSON string literal (quoted and escaped)."""
    inner = F.to_json(F.array(_col(c)))
    return F.substr(inner, F.lit(2), F.length(inner) - 2)


def json_array_line(*cols: str | Column, strings: tuple[int, ...] = (0,)) -> Column:
    """JSON array text such as ``["a", 1.5]`` from mixed string / number columns.

    ``to_json(array(...))`` needs one element type, so each element is rendered
    on its own: positions in ``strings`` through :func:`json_string`, the rest
    as number text. NULL, NaN and infinite values become ``null``.
    """
    def number(c):
        shown = _col(c).cast("string")
        return F.when(~shown.isin("NaN", "Infinity", "-Infinity"), shown)

    parts = [
        F.coalesce(F.when(_col(c).isNotNull(), json_string(c)) if i in strings else number(c), F.lit("null"))
        for i, c in enumerate(cols)
    ]
    return F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))
