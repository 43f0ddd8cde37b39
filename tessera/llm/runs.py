"""Periodic runs of words: maximal pairs enumerated bottom-up over the LCP-interval tree.

The words of a text are put in suffix order; the tree of LCP intervals is
walked bottom-up on a stack. An interval of depth ``l`` holds the places that
share their next ``l`` words, as a sorted list and as lists by the word to
their left. When a child joins, a place of the smaller side is paired with the
places of the other side that are near enough and have another left word:
such a pair can be extended neither to the left (other words) nor to the right
(another child), so it is a *maximal pair*. A maximal pair ``i < j`` with
distance ``d = j - i`` that is long enough for its distance is the whole
stretch ``i .. j + l`` of period ``d``: it is a run as it stands, with no
extension and no check of its neighbours. The smallest distance of a stretch
is its period.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4


def _least_common(least: int, times: int) -> int:
    """No run's maximal pair shares fewer words: length - period, at the shortest length of any period."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``ids`` in order, and how many words each shares with the one before.

    Ranks by the first 1, 2, 4, ... words until all differ; the shared lengths
    are read from the same ranks, from the longest to the shortest.
    """
    n = len(ids)
    ranks = [np.append(np.unique(ids, return_inverse=True)[1].astype(np.int64), -1)]
    width = 1
    while ranks[-1][:n].max() < n - 1:
        rank = ranks[-1]
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[:max(0, n - width)] = rank[width:n]
        ranks.append(np.append(np.unique(rank[:n] * (n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64), -1))
        width *= 2
    order = np.empty(n, dtype=np.int64)
    order[ranks[-1][:n]] = np.arange(n)
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        # past the end both look at -1, which equal places can't both reach: suffixes differ in length
        same = ranks[k][np.minimum(left, n)] == ranks[k][np.minimum(right, n)]
        same &= (left < n) & (right < n)
        step = same.astype(np.int64) << k
        shared[1:] += step
        left += step
        right += step
    return order, shared


class _Places:
    """Places of an interval: all in order, and by the word on their left."""

    __slots__ = ("all", "by")

    def __init__(self, place: int, left: int) -> None:
        self.all, self.by = [place], {left: [place]}

    def others(self, left: int, low: int, high: int) -> Iterator[int]:
        """Places from ``low`` to ``high`` whose left word is another, found by halving where the two lists differ in number."""
        own = self.by.get(left, ())
        open_ = [(bisect_left(self.all, low), bisect_right(self.all, high))]
        while open_:
            a, b = open_.pop()
            if a >= b or b - a == bisect_right(own, self.all[b - 1]) - bisect_left(own, self.all[a]):
                continue
            if b - a == 1:
                yield self.all[a]
                continue
            open_ += [(a, (a + b) // 2), ((a + b) // 2, b)]

    def add(self, other: _Places) -> None:
        if len(other.all) == 1:
            insort(self.all, other.all[0])
        else:
            self.all = sorted(self.all + other.all)
        for left, places in other.by.items():
            own = self.by.get(left)
            if own is None:
                self.by[left] = places
            elif len(places) == 1:
                insort(own, places[0])
            else:
                self.by[left] = sorted(own + places)


def find_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs of ``ids`` as (start, length, period), by start, then period."""
    n = len(ids)
    floor = _least_common(least, times)
    if n < least or not _repeats(ids, floor):
        return []
    order, shared = suffix_order(ids)
    before = [-1, *ids[:-1].tolist()]
    found: dict[tuple[int, int], int] = {}

    def join(depth: int, into: _Places, child: _Places) -> _Places:
        """Emits the maximal pairs of ``depth`` shared words between the two and returns their union."""
        if len(child.all) > len(into.all):
            into, child = child, into
        reach = depth // (times - 1)
        for left, places in child.by.items():
            for place in places:
                for other in into.others(left, place - reach, place + reach):
                    i, j = (place, other) if place < other else (other, place)
                    period, end = j - i, j + depth
                    if end - i >= max(least, times * period) and period < found.get((i, end), n):
                        found[i, end] = period
        into.add(child)
        return into

    open_: list[tuple[int, _Places]] = []
    # intervals that share fewer words than any run needs are not built: the tree is walked below that depth only
    for k in np.flatnonzero((shared >= floor) | (np.append(shared[1:], 0) >= floor)).tolist():
        here, place = int(shared[k]), int(order[k])
        # the place before this one was the last child at its own depth; close what is deeper than what is shared with it
        _close(open_, here if here >= floor else 0, join)
        open_.append((n, _Places(place, before[place])))
    _close(open_, 0, join)
    return sorted((i, end - i, period) for (i, end), period in found.items())


def _close(open_: list[tuple[int, _Places]], shared: int, join: Callable) -> None:
    """Folds the open intervals deeper than ``shared`` into one of that depth; at 0 they end.

    ``open_`` holds (depth, places) with growing depths; a single place is on top with a depth above all.
    """
    if not open_:
        return
    _, top = open_.pop()
    while open_ and open_[-1][0] >= max(shared, 1):
        depth, places = open_.pop()
        top = join(depth, places, top)
        if depth == shared:
            break
    if shared:
        open_.append((shared, top))


def _repeats(ids: np.ndarray, width: int) -> bool:
    """Whether some ``width`` words in a row occur twice; rarely true where they don't (by a hash)."""
    if len(ids) <= width:
        return False
    value = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(29)
    mixed = np.zeros(len(ids) - width + 1, dtype=np.uint64)
    for k in range(width):
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) + value[k:len(ids) - width + 1 + k]
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def number(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that lie in a run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, kept in zip(words, keep.tolist()) if kept]


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def collapse_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                  edit: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``runs`` (start, length, period) and the ``collapsed`` text.

    Words are separated by blanks and the control characters tab to carriage
    return; ``collapsed`` is the kept words joined by one blank. ``edit`` may
    change a row's words (as UTF-8) first, knowing its id. Null and empty texts
    have no words and an empty ``collapsed``; null ids and repeated rows are
    rows like any other; other columns are not read. Texts are never shuffled;
    a task holds one batch of them, and one text's tree, at a time.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    fields = ("start", "length", "period")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes are split at just the blanks that separate words here
                words = (value.as_py() or "").encode().split()
                if edit is not None:
                    words = edit(words, key)
                runs = find_runs(number(words)) if len(words) >= LEAST else []
                counts.append(len(words))
                found.append([dict(zip(fields, r)) for r in runs])
                texts.append(b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(run)), pa.array(texts, pa.large_string()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    kind = own.schema["id"].dataType.simpleString()
    out = own.mapInArrow(scan, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def with_periodic_tail(words: list[bytes], key: object) -> list[bytes]:
    """The words of a text whose id draws a periodic tail, with that tail; others, and those without id, as they are."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + [part[i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, after giving every tenth a periodic tail: count, the most repeated one, digests."""
    found = collapse_runs(table(spark, sf_dir, "documents"), edit=with_periodic_tail)

    def order(a: Column, b: Column) -> Column:
        """By exact length / period, the largest first; then start; then period."""
        more = a["length"] * b["period"] - b["length"] * a["period"]
        return (F.when(more > 0, -1).when(more < 0, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.when(F.col("best").isNotNull(), F.floor(F.expr("1000 * best.length div best.period"))).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
