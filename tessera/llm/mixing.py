"""Mixing sources to target weights: iterative proportional fitting over a cell table.

Tokens are summed per cell (source, language, topic). Raking scales the cells
again and again so that their sums over one dimension after the other meet
that dimension's targets, until all three do. A cell's raked weight, as a part
of the token budget, over the tokens that it has is the probability with which
each of its documents is sampled. No cell can give more tokens than it has:
one that is asked for more is taken whole, and raking deals what it can't give
to the other cells of the same values.

Cells and marginals are Spark tables, as their number grows with the sources.
A cell table whose bytes are counted and within a bound is raked by one task,
which spares a loop of small jobs; a bigger one by joins and aggregates, with
the same arithmetic.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, free_name, stored, table, words_of

NULL = "(null)"
#: Production targets: a number is the power that token shares are raised to (1 keeps them, 0 evens them out).
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.7, "lang": 0.7, "topic": 0.85}
BUDGET = 0.8
#: Sweeps at most, and sweeps without a gain after which raking ends.
SWEEPS, PATIENCE = 100, 3
#: Largest cell table, in bytes, that one task rakes, and what a cell counts beside its dimensions' texts.
TASK_BYTES, CELL_BYTES = 32 * 1024 * 1024, 64
LOG = logging.getLogger(__name__)


def topic_of(text: Column, n_words: Column) -> Column:
    """A coarse topic from the whole text: markup, legal, contact, note, prose or long."""
    value = F.lower(F.coalesce(text, F.lit("")))
    symbols = F.regexp_count(value, F.lit("[#*$%&|<>]"))
    return (
        F.when(symbols * 100 > F.char_length(value), "markup")
        .when(value.contains("licen") | value.contains("copyright"), "legal")
        .when(value.contains("@") | value.contains("://"), "contact")
        .when(n_words < 100, "note").when(n_words >= 1_500, "long").otherwise("prose")
    )


def with_cell(docs: DataFrame, names: dict[str, str], text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """``docs`` with the three dimensions as strings (null is a value of its own) and the tokens (words, one at least).

    ``names`` says what the new columns are called.
    """
    counted = docs.withColumn(names["tokens"], F.greatest(F.size(words_of(text)).cast("long"), F.lit(1).cast("long")))
    return counted.withColumns({
        names["source"]: F.coalesce(F.col(source).cast("string"), F.lit(NULL)),
        names["lang"]: F.coalesce(F.col(lang).cast("string"), F.lit(NULL)),
        names["topic"]: topic_of(F.col(text), F.col(names["tokens"])),
    })


def _target(cells: DataFrame, dimension: str, wanted: float | dict[str, float]) -> DataFrame:
    """(dimension, goal): target shares that sum to 1 over the values the data has."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("t"))
    if isinstance(wanted, dict):
        rows = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in wanted.items()], f"{dimension} string, g double")
        shares = sums.join(F.broadcast(rows), dimension, "left").select(dimension, F.coalesce("g", F.lit(0.0)).alias("g"))
    else:
        shares = sums.select(dimension, F.pow("t", F.lit(float(wanted))).alias("g"))
    whole = shares.agg(F.sum("g").alias("all"))
    return shares.join(F.broadcast(whole), F.lit(True)).select(dimension, F.coalesce(F.try_divide("g", "all"), F.lit(0.0)).alias("goal"))


def _reachable(cells: DataFrame, dimension: str, goals: DataFrame) -> DataFrame:
    """``goals`` with ``goal`` no value's cells can't give: what is above goes to the other values, in proportion.

    A goal is the smaller of the value's room (the sum of ``most`` over its
    cells) and its target times one number, which rises until the goals sum to
    1 or no room is left. Only that number is known to the driver.
    """
    rooms = stored(cells.groupBy(dimension).agg(F.sum("most").alias("room")).join(goals, dimension).select(dimension, "goal", "room"))
    times = 1.0
    while True:
        full = F.col("goal") * F.lit(times) >= F.col("room")
        taken, left = rooms.agg(F.coalesce(F.sum(F.when(full, F.col("room"))), F.lit(0.0)),
                                F.coalesce(F.sum(F.when(~full, F.col("goal"))), F.lit(0.0))).first()
        higher = (1 - taken) / left if left > 0 and taken < 1 else times
        if higher <= times * (1 + 1e-12):
            return rooms.select(dimension, F.col("goal").alias("target"), F.least("room", F.col("goal") * F.lit(times)).alias("goal"))
        times = higher


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]], budget: float | None = None, tolerance: float = 1e-4,
         most: int = SWEEPS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``weight``: shares whose marginals meet the targets.

    A number as target tempers the dimension's token shares by that power; a
    dict gives weights, and values it doesn't name get none. With ``budget``,
    the part of all tokens that is wanted, no weight is above what the cell
    has: weights are the smaller of that and a product of one factor per value,
    and a value's factor is found from the cells that aren't full. Goals that a
    value can't reach with all its cells are dealt to the others first.

    Stops when no marginal is off by more than ``tolerance``, when some sweeps
    gain nothing (as when targets contradict each other through empty cells),
    or after ``most`` sweeps; if a marginal is still off then, a warning is
    logged, and :func:`misses` tells which. Dimensions hold no nulls.

    A table of at most ``task_bytes`` bytes is raked by one task. Beyond, a
    sweep over all dimensions is one plan and one written table, so that no
    plan nests earlier sweeps; the driver sees one number a sweep.
    """
    size = sum((F.octet_length(F.col(d)) for d in targets), F.lit(CELL_BYTES))
    if (cells.agg(F.sum(size)).first()[0] or 0) <= task_bytes:
        raked, worst = _rake_in_task(cells, targets, budget, tolerance, most)
    else:
        raked, worst = _rake_by_joins(cells, targets, budget, tolerance, most)
    if worst is not None and worst > tolerance:
        LOG.warning("raking ended with a marginal %.6f off its goal", worst)
    return raked


def _goes_on(worst: float, best: float, idle: int, tolerance: float) -> tuple[bool, float, int]:
    """Whether another sweep is worth it, the best miss so far, and how many sweeps gained nothing."""
    idle = 0 if worst < best - tolerance / SWEEPS else idle + 1
    return worst > tolerance and idle < PATIENCE, min(best, worst), idle


def _rake_in_task(cells: DataFrame, targets: dict, budget: float | None, tolerance: float, most: int) -> tuple[DataFrame, float | None]:
    """:func:`rake` of a table that fits one task, and the largest miss (None: no cells)."""
    miss, columns, wanted = free_name(cells, "_miss"), cells.columns, list(targets.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(frames) or [pd.DataFrame(columns=columns)], ignore_index=True)
        if len(held):
            weight, worst = rake_arrays([held[d].to_numpy(object) for d in targets], held["tokens"].to_numpy(float), wanted, budget, tolerance, most)
            yield held.assign(weight=weight, **{miss: worst})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    raked = stored(cells.repartition(1).mapInPandas(run, f"{fields}, weight double, `{miss}` double"))
    first = raked.select(miss).first()
    return raked.drop(miss), first[0] if first else None


def rake_arrays(dimensions: list[np.ndarray], tokens: np.ndarray, targets: list, budget: float | None, tolerance: float,
                sweeps: int) -> tuple[np.ndarray, float]:
    """Raked weights of cells given as one array a dimension, and the largest difference of a marginal from its goal."""
    raw = tokens / max(tokens.sum(), 1e-300)
    most = raw / budget if budget else np.full(len(raw), math.inf)
    places, goals = [], []
    for values, wanted in zip(dimensions, targets):
        names, place = np.unique(values, return_inverse=True)
        goal = np.array([float(wanted.get(v, 0.0)) for v in names]) if isinstance(wanted, dict) else np.bincount(place, tokens) ** float(wanted)
        goal, room, times = goal / (goal.sum() or 1.0), np.bincount(place, most), 1.0
        while True:  # goals beyond a value's room are dealt to the others
            full = goal * times >= room
            taken, left = room[full].sum(), goal[~full].sum()
            higher = (1 - taken) / left if left > 0 and taken < 1 else times
            if higher <= times * (1 + 1e-12):
                break
            times = higher
        places.append(place)
        goals.append(np.minimum(room, goal * times))
    best, idle, worst, more = math.inf, 0, 0.0, True
    for _ in range(sweeps):
        for place, goal in zip(places, goals):
            full, n = raw >= most, len(goal)
            held = np.bincount(place, np.minimum(raw, most), n)
            fixed, free = np.bincount(place[full], most[full], n), np.bincount(place[~full], raw[~full], n)
            less = np.where(held > 0, np.minimum(1.0, goal / np.where(held > 0, held, 1.0)), 1.0)
            raw = raw * np.where((free > 0) & (goal > fixed), (goal - fixed) / np.where(free > 0, free, 1.0), less)[place]
        weight = np.minimum(raw, most)
        worst = max(float(np.abs(np.bincount(p, weight, len(g)) - g).max()) for p, g in zip(places, goals))
        more, best, idle = _goes_on(worst, best, idle, tolerance)
        if not more:
            break
    return np.minimum(raw, most), worst


def _rake_by_joins(cells: DataFrame, targets: dict, budget: float | None, tolerance: float, most: int) -> tuple[DataFrame, float | None]:
    """:func:`rake` of a table of any size, and the largest miss (None: no cells)."""
    whole = cells.agg(F.sum("tokens").cast("double").alias("whole"))
    share = F.col("tokens") / F.col("whole")
    now = cells.join(F.broadcast(whole), F.lit(True)).withColumn("raw", share)
    now = stored(now.withColumn("most", share / F.lit(float(budget)) if budget else F.lit(math.inf)).drop("whole"))
    goals = {d: stored(_reachable(now, d, _target(cells, d, wanted))) for d, wanted in targets.items()}
    goal_of_all = reduce(DataFrame.unionAll, [g.select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "goal") for d, g in goals.items()])
    weight, full = F.least("raw", "most"), F.col("raw") >= F.col("most")

    def marginal(weighted: DataFrame, d: str) -> DataFrame:
        return weighted.groupBy(d).agg(
            F.sum(weight).alias("sum"), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("raw"))), F.lit(0.0)).alias("free")).join(goals[d], d)

    best, idle, worst = math.inf, 0, None
    for _ in range(most):
        for d in targets:
            by_free = F.when((F.col("free") > 0) & (F.col("goal") > F.col("fixed")), (F.col("goal") - F.col("fixed")) / F.col("free"))
            factor = F.coalesce(by_free, F.least(F.lit(1.0), F.try_divide("goal", "sum")), F.lit(0.0))
            now = now.join(marginal(now, d).select(d, factor.alias("factor")), d).withColumn("raw", F.col("raw") * F.col("factor")).drop("factor")
        now = stored(now)
        ends = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in targets]))
        sums = now.select(ends.alias("end"), weight.alias("w")).groupBy("end.dimension", "end.value").agg(F.sum("w").alias("sum"))
        worst = sums.join(goal_of_all, ["dimension", "value"]).agg(F.max(F.abs(F.col("sum") - F.col("goal")))).first()[0]
        if worst is None:
            break
        more, best, idle = _goes_on(worst, best, idle, tolerance)
        if not more:
            break
    return now.withColumn("weight", weight).drop("raw", "most"), worst


def misses(cells: DataFrame, targets: dict[str, float | dict[str, float]] | None = None) -> DataFrame:
    """(dimension, value, target, reached) of every marginal of raked ``cells``: what was wanted and what came out."""
    parts = []
    for d, wanted in (targets or TARGETS).items():
        sums = cells.groupBy(d).agg(F.sum("weight").alias("reached"))
        parts.append(_target(cells, d, wanted).join(sums, d).select(
            F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col("goal").alias("target"), "reached"))
    return reduce(DataFrame.unionAll, parts)


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """Raked cells with ``p``: ``budget`` of all tokens, dealt by weight, over the cell's tokens; 1 at most."""
    whole = cells.agg(F.sum("tokens").cast("double").alias("whole"))
    rate = F.col("weight") * budget * F.col("whole") / F.col("tokens")
    return cells.join(F.broadcast(whole), F.lit(True)).withColumn("p", F.round(F.least(F.lit(1.0), rate), 12)).drop("whole")


def calibrate(rows: DataFrame, targets: dict | None = None, budget: float = BUDGET) -> DataFrame:
    """Stored cells of ``rows`` (source, lang, topic, tokens) with tokens, weight and ``p``."""
    targets = targets or TARGETS
    cells = stored(rows.groupBy(*targets).agg(F.sum("tokens").alias("tokens")))
    return stored(probabilities(rake(cells, targets, budget), budget))


def draw(id_col: str, text: str, seed: int = 17) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _with_cells(rows: DataFrame, cells: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` joined to their cells; ``names``: a cell column's name in ``rows``.

    The cells are a stored table, so the planner knows their bytes: it
    broadcasts them below Spark's own threshold and shuffles beyond.
    """
    own = {d: free_name(rows, f"_cell_{d}") for d in TARGETS}
    known = cells.select(*[F.col(d).alias(own[d]) for d in TARGETS], F.col("weight").alias(names["weight"]), F.col("p").alias(names["p"]))
    on = reduce(Column.__and__, [F.col(names[d]) == F.col(own[d]) for d in TARGETS])
    return rows.join(known, on).drop(*own.values())


def sample(docs: DataFrame, text: str = "text", id_col: str = "doc_id", targets: dict | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled documents, with their own columns: two narrow passes, one for the cells and one to draw.

    A draw depends on the document alone, so it is the same after a task is
    repeated; equal rows are drawn alike. Null and empty texts count one token,
    null sources and languages are a value of their own. An empty table gives
    an empty table.
    """
    names = {d: free_name(docs, f"_{d}") for d in (*TARGETS, "tokens", "weight", "p")}
    marked = with_cell(docs, names, text)
    cells = calibrate(marked.select(*[F.col(names[d]).alias(d) for d in (*TARGETS, "tokens")]), targets, budget)
    return _with_cells(marked, cells, names).filter(draw(id_col, text) < F.col(names["p"])).select(*docs.columns)


def op3_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, raked weight, probability and whether it is sampled."""
    names = {d: d for d in (*TARGETS, "tokens", "weight", "p")}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    rows = checkpointed(with_cell(docs, names).select("doc_id", *TARGETS, "tokens", draw("doc_id", "text").alias("u")))
    found = _with_cells(rows, calibrate(rows), names)
    return found.select("doc_id", "source", "lang", "topic", "tokens", F.round("weight", 9).alias("weight"), "p", (F.col("u") < F.col("p")).alias("sampled"))
